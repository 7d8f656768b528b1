"""Tokenization and dictionary matching.

Plan shape (one pass per document, no shuffle before the join):

    scan -> pieces = regexp_extract_all(text)        (lossless pieces)
         -> posexplode(pieces)                       one row per piece
         -> BroadcastHashJoin(piece = dictionary first token)
         -> the next tokens, looked up in the piece array, equal the entry's

The piece array stays referenced by the exploded rows inside one codegen
stage; only pieces that start an entry leave it, and per-hit work (next
tokens, span text, offsets, the value window) reads a bounded slice of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribeflow.functions.text import PIECE_PATTERN


#: Text bytes of a task whose pieces become rows: they are many times as long, and what is sorted by
#: document must stay in memory.
PART_BYTES, LEAST_PARTS = 8 << 20, 32


def tokenize(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Token table: (doc_id, tok_idx, piece_idx, start_char, end_char, tok, tok_lower).

    Offsets are code points, 0-based, end exclusive: running sums of piece
    lengths over a document.  The texts are dealt by document before they are
    cut, so no piece is ever shuffled, and a part holds a bounded amount of
    text (or one document).  Documents without an id give no tokens.
    """
    d = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    size = d.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    d = d.repartition(max(LEAST_PARTS, -(-size // PART_BYTES)), "doc_id")
    p = d.select("doc_id", F.posexplode(F.regexp_extract_all("_text", F.lit(PIECE_PATTERN), 0)).alias("piece_idx", "tok"))
    p = p.withColumn("_len", F.char_length("tok").cast("long"))
    w = Window.partitionBy("doc_id").orderBy("piece_idx").rowsBetween(Window.unboundedPreceding, 0)
    t = p.withColumn("_end", F.sum("_len").over(w)).withColumn("_toks", F.sum((F.col("tok") != " ").cast("long")).over(w)).where(F.col("tok") != " ")
    return t.select(
        "doc_id",
        (F.col("_toks") - 1).alias("tok_idx"),
        "piece_idx",
        (F.col("_end") - F.col("_len")).alias("start_char"),
        F.col("_end").alias("end_char"),
        "tok",
        F.lower("tok").alias("tok_lower"),
    )


def match_dictionary(
    docs: DataFrame,
    dictionary: DataFrame,
    max_n: int,
    text_col: str = "text",
    id_col: str = "doc_id",
    keep: tuple[str, ...] = (),
    want_offsets: bool | Column = False,
    window_labels: tuple[str, ...] = (),
    window_chars: int = 50,
) -> DataFrame:
    """All (overlapping) dictionary hits in the documents.

    ``dictionary`` has columns ``toks`` (array<string>, lower-cased), ``n``
    and any payload; it must be small (it is broadcast by the caller's
    decision, see ``reference.broadcast_checked``).  ``max_n`` is the longest
    phrase in tokens.

    Returns per hit: doc_id, tok_pos, span_text (as written) + payload columns
    (+ start_char, end_char when ``want_offsets`` - a Column limits them to
    the hits it is true for; + ``after`` = the
    ``window_chars`` characters after the span for rows whose ``label`` is in
    ``window_labels``).
    """
    m = max(1, int(max_n))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *keep)
    d = src.select("doc_id", *keep, "_text", F.regexp_extract_all(F.col("_text"), F.lit(PIECE_PATTERN), 0).alias("pieces"))
    # prefix sums over blocks of _B pieces (_B ~ sqrt(pieces), so the appends stay linear in the
    # document): tokens and code points before each block; one block, as nearly all documents
    # have, needs none
    d = d.withColumn("_B", F.greatest(F.lit(512), F.ceil(F.sqrt(F.size("pieces"))).cast("int")))
    none = F.array(F.struct(F.lit(0).alias("t"), F.lit(0).cast("long").alias("s")))
    sums = F.aggregate(
        "pieces",
        F.struct(F.array().cast("array<struct<t:int,s:bigint>>").alias("c"), F.lit(0).alias("t"), F.lit(0).cast("long").alias("s"),
                 F.lit(0).alias("k")),
        lambda st, p: F.struct(
            F.when(st["k"] % F.col("_B") == 0, F.array_append(st["c"], F.struct(st["t"].alias("t"), st["s"].alias("s")))).otherwise(st["c"]).alias("c"),
            (st["t"] + (p != " ").cast("int")).alias("t"),
            (st["s"] + F.char_length(p)).alias("s"),
            (st["k"] + 1).alias("k")),
        lambda st: st["c"])
    d = d.withColumn("_before", F.when(F.size("pieces") <= F.col("_B"), none).otherwise(sums))
    # outer, as the optimizer else filters the documents by their piece array and so makes it thrice
    ex = d.select("doc_id", *keep, "_text", "pieces", "_B", "_before", F.posexplode_outer("pieces").alias("first_piece", "w0")).where(F.col("w0") != " ")

    # an entry's tokens and the text's next n, joined by a blank: no token holds a single one, and
    # no two single blanks follow each other in the pieces
    dic = dictionary.withColumn("p0", F.element_at("toks", 1)).withColumn("_said", F.array_join("toks", " "))
    begin, n = F.col("first_piece") + 1, F.col("n")
    said = F.lower(F.array_join(F.slice(F.array_remove(F.slice("pieces", begin, 2 * n - 1), " "), F.lit(1), n), " "))
    out = ex.join(dic, (F.lower("w0") == F.col("p0")) & ((n == 1) | (said == F.col("_said"))), "inner")

    # the last token's piece ends the shortest run of pieces that has n tokens; that run is the
    # tokens as written
    last = reduce(lambda acc, k: acc.when(F.size(F.array_remove(F.slice("pieces", begin, F.lit(k)), " ")) == n, F.col("first_piece") + (k - 1)),
                  range(2, 2 * m), F.when(n == 1, F.col("first_piece")))
    out = out.withColumn("last_piece", last)
    span = F.array_join(F.slice("pieces", F.col("first_piece") + 1, F.col("last_piece") - F.col("first_piece") + 1), "")
    out = out.withColumn("span_text", span)
    # block start and at most one block of pieces
    fp, bsz = F.col("first_piece"), F.col("_B")
    blk = (fp / bsz).cast("int")
    out = out.withColumn("_at", F.element_at("_before", blk + 1)).withColumn("_in", F.slice("pieces", blk * bsz + 1, fp - blk * bsz))
    out = out.withColumn("tok_pos", F.col("_at.t") + F.size(F.array_remove("_in", " ")))
    extra = []
    if want_offsets is not False:
        start = (F.col("_at.s") + F.char_length(F.array_join("_in", ""))).cast("long")
        if isinstance(want_offsets, Column):
            start = F.when(want_offsets, start)
        out = out.withColumn("start_char", start)
        out = out.withColumn("end_char", (F.col("start_char") + F.char_length("span_text")).cast("long"))
        extra += ["start_char", "end_char"]
    if window_labels:
        # cut from a text of one block where the offset is known; from a few pieces of a longer one
        after = F.substring(F.array_join(F.slice("pieces", F.col("last_piece") + 2, window_chars), ""), 1, window_chars)
        if want_offsets is not False:
            short = (F.size("pieces") <= F.col("_B")) & F.col("end_char").isNotNull()
            after = F.when(short, F.substring("_text", F.col("end_char").cast("int") + 1, F.lit(window_chars))).otherwise(after)
        out = out.withColumn("after", F.when(F.col("label").isin(list(window_labels)), after))
        extra += ["after"]
    payload = [c for c in dictionary.columns]
    return out.select("doc_id", *keep, "tok_pos", "first_piece", "last_piece", "span_text", *payload, *extra)
