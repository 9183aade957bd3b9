"""Periodic runs against a plain search over all periods."""
import hashlib
import re
import zlib

import numpy as np
import pytest

from revlens.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    queries.prepare(spark)


def plain_runs(w, least=12):
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, 2 * q):
                out.setdefault((s, i - s + q), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def planted(i, text):
    w = WORD.findall(text or "")
    h = None if i is None else zlib.crc32(str(i).encode())
    if h is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]


def report(i, text):
    w = planted(i, text)
    runs = plain_runs(w)
    drop = {j for s, n, q in runs for j in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in drop).encode()).hexdigest())


def texts():
    rng = np.random.default_rng(3)
    out = [None, "", " \n\t ", "one", "a " * 11, "a " * 12, "a " * 500, "a b " * 6, "a b " * 5 + "a", "Ü é\t" * 40 + "x"]
    out.append(" ".join(list("ab" * 10 + "a" + "ab" * 10 + "a")))
    out.append((" ".join("a" * 40) + " b ") * 8)
    out.append(" ".join(f"w{j}" for j in range(30)) + " " + " ".join(f"w{j}" for j in range(30)))
    fib = ["a", "b"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    out.append(" ".join(fib[-1]))
    for size in (2, 3, 5):
        for n in (13, 60, 250):
            out += [" ".join(rng.choice([f"x{j}" for j in range(size)], n)) for _ in range(25)]
    for _ in range(40):  # pieces repeated inside other words
        piece = rng.choice([f"y{j}" for j in range(6)], rng.integers(1, 20))
        out.append(" ".join([*rng.choice([f"z{j}" for j in range(9)], rng.integers(0, 20)), *np.tile(piece, 5)[:rng.integers(2, 90)],
                             *rng.choice([f"z{j}" for j in range(9)], rng.integers(0, 20))]))
    return out


def test_runs_match_all_periods(spark):
    rows = list(enumerate(texts()))
    rows += [(None, "a b c " * 9), (None, None), (rows[6][0], rows[6][1])]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, runs string, collapsed string").repartition(5)
    got = periodic.run_report(periodic.find_runs(periodic.with_planted_periods(docs))).collect()
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((report(i, t) for i, t in rows), key=key)


@pytest.mark.parametrize("least", [2, 5, 20])
def test_other_least_lengths(least):
    rng = np.random.default_rng(least)
    for _ in range(60):
        w = rng.integers(0, 3, rng.integers(1, 80))
        got = periodic.word_runs(w.astype(np.uint64) + np.uint64(7), np.zeros(len(w), np.int64), least)
        assert sorted(zip(*(x.tolist() for x in got))) == plain_runs(w.tolist(), least)


def test_a_very_long_text_of_one_word():
    n = 1_000_000
    start, length, period = periodic.word_runs(np.full(n, 5, np.uint64), np.zeros(n, np.int64))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [n], [1])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.run_report(periodic.find_runs(periodic.with_planted_periods(docs))).collect() == []


def test_query_on_the_given_documents(spark):
    from conftest import SF_SMALL
    got = {r.doc_id: tuple(r) for r in queries.queries()["op13_periodic_runs"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert set(got) == {d.doc_id for d in docs}
    short = [d for d in docs if len(d.text or "") < 12_000]
    assert len(short) > 100 and {d.doc_id: got[d.doc_id] for d in short} == {d.doc_id: report(d.doc_id, d.text) for d in short}
