"""Spark operators against small pure-Python models of the same rules, on
seeded random texts (brute force on a small fixture)."""

import random
import re

import regex

from scribeflow import fixed_values as fv
from scribeflow.functions.text import PIECE_PATTERN
from scribeflow.operators import classify as C
from scribeflow.operators import extract as X
from scribeflow.sources import reference as R

WORDS = ["dosage", "Dosage", "refills", "as", "needed", "history", "medical", "past", "plan", "result",
         "test", "results", "units", "glucose", "Lisinopril", "hypertension", "chest", "pain", "is", "mg",
         "x", "HPI", "H&P", "follow-up", "follow", "-", "up"]
SEPS = [" ", " ", " ", "  ", "\n", ": ", " - ", ", ", " is ", "\t"]


def _texts(n, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 30)):
            w = rnd.choice(WORDS)
            if rnd.random() < 0.2:
                w = f"{w}: {rnd.randint(1, 2500)}{rnd.choice(['', ' ', '.5 '])}{rnd.choice(['mg', 'mg/dL', '%', '', 'bpm'])}"
            parts += [w, rnd.choice(SEPS)]
        out.append("".join(parts))
    return out


def _tokens(text):
    pieces = regex.findall(PIECE_PATTERN, text)
    return [(i, p) for i, p in enumerate(pieces) if p != " "]


def _py_classify(text, phrases):
    """phrases: {doc_type: (type_ord, {phrase_lower: weight}, [token tuples])}."""
    toks = _tokens(text)
    low = [p.lower() for _, p in toks]
    scores, found = {}, {}
    for t, (_, weights, seqs) in phrases.items():
        scores[t], found[t] = 0.0, set()
        for seq in seqs:
            n = len(seq)
            for i in range(len(toks) - n + 1):
                if tuple(low[i:i + n]) == seq:
                    span = toks[i][1]
                    for k in range(1, n):
                        span += (" " if toks[i + k][0] - toks[i + k - 1][0] == 2 else "") + toks[i + k][1]
                    scores[t] += weights.get(span.lower(), 1.0)
                    found[t].add(span)
    totals = {t: sum(w.values()) for t, (_, w, _) in phrases.items()}
    norm = {t: (scores[t] / totals[t] if totals[t] > 0 else 0.0) for t in phrases}
    order = sorted(phrases, key=lambda t: phrases[t][0])
    best = max(order, key=lambda t: norm[t])
    if norm[best] < 0.5:
        return "unknown", norm[best], []
    return best, norm[best], sorted(found[best])


def test_classification_matches_python_model(spark):
    ph_df = R.doc_phrase_table(R.default_dictionaries(spark)["document_keywords"])
    phrases = {}
    for r in ph_df.collect():
        entry = phrases.setdefault(r["doc_type"], (r["type_ord"], {}, set()))
        entry[1][r["phrase_lower"]] = r["weight"]
        entry[2].add(tuple(r["toks"]))
    texts = _texts(150, 5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["document_type"], r["confidence"], r["keywords_found"])
           for r in C.classify(docs, ph_df).collect()}
    for i, t in enumerate(texts):
        want = _py_classify(t, phrases)
        g = got[i]
        assert (g[0], round(g[1], 12), g[2]) == (want[0], round(want[1], 12), want[2]), (t, g, want)


VALUE_RE_PY = re.compile(fv.VALUE_PATTERN, re.IGNORECASE)


def _py_value(after):
    m = VALUE_RE_PY.search(after)
    if not m:
        return None, None
    v, u = m.group(1), (m.group(2) or None)
    try:
        if 1900 < float(v) < 2100:
            return None, None
    except ValueError:
        pass
    return v, u


def test_value_window_matches_python_re(spark):
    rnd = random.Random(9)
    alphabet = ["is", "Is ", " IS", ":", "-", " ", "  ", "\n", "Dosage", "dosage", "1", "20", "120/80", "3.5",
                "2021", "mg", "μg", "µL", "%", "°C", "/", "x", ".", ",", "isn't", "this", "levels"]
    wins = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14)))[:50] for _ in range(400)]
    df = spark.createDataFrame([(w,) for w in wins], "after string")
    v, u = X.value_unit("after")
    got = [(r[0], r[1]) for r in df.select(v, u).collect()]
    for w, g in zip(wins, got):
        assert g == _py_value(w), (w, g)
