"""Source divergences: against plain integer arithmetic on the whole table."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlake.llm import divergence

from . import helpers as h

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=10):
    """rows of (text, lang, source)."""
    counts, documents, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((t or "", x or "", s or "") for t, x, s in rows):
        terms = TERM.findall(h.lower(text))
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
        sources[lang].add(source)
    found = []
    apart = lambda p, q: (p - q) * (p - q) // (p + q)
    for lang, mine in sources.items():
        kept = [t for t, n in documents[lang].items() if n >= least]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in mine}
        every = sum(total.values())
        share = lambda n, of: 1 + 10**9 * (n + 2) // (of + 2 * len(kept))  # noqa: E731, B023
        for s in mine:
            p = {t: share(counts[lang, s][t], total[s]) for t in kept}
            pairs = [(o, sum(apart(p[t], share(counts[lang, o][t], total[o])) for t in kept)) for o in mine - {s}]
            q = {t: share(sum(counts[lang, o][t] for o in mine), every) for t in kept}
            terms = [(t, apart(p[t], q[t])) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                found += [(lang, s, part, item, value, r + 1) for r, (item, value) in enumerate(ranked)]
    return found


def some_rows(n=400, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß名") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    rows = []
    for _ in range(n):
        source = rng.choice(["s0"] * 6 + ["s1", "s2", "ß", None, ""])
        text = " ".join(rng.choice(vocabulary[: 40 if source == "s1" else None]) for _ in range(rng.randint(0, 40)))
        rows.append((text.upper() if rng.random() < 0.3 else text, rng.choice(["en", "en", "fr", None, ""]), source))
    odd = [(None, "en", "quiet"), ("", None, None), ("a" * 5000, "en", "s1"), ("É é x\x7fy_z-1w", "en", "s1"), ("only here", "xx", "one"), ("é" * 50_000 + " a b", "fr", "s0")]
    return rows + odd + [("tie one two", "tt", s) for s in "ab" for _ in range(6)] + rows[:3]


def found_in(spark, rows):
    docs = h.frame(spark, [(i, t, x, s, 0) for i, (t, x, s) in enumerate(rows)])
    return divergence.divergences(docs)


def test_equal_plain_counts(spark):
    rows = some_rows()
    found = found_in(spark, rows)
    assert found.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    h.same_rows(found, found.columns, plain(rows))


def test_spills_and_blocks_change_nothing(spark, monkeypatch):
    rows = some_rows(150, seed=9)
    wanted = sorted(map(tuple, found_in(spark, rows).collect()))
    assert wanted == sorted(plain(rows))
    for name, value in (("SPILL", 20), ("LISTED", 10), ("BLOCK_TERMS", 3), ("AT_A_TIME", 5)):
        monkeypatch.setattr(divergence, name, value)
    assert sorted(map(tuple, found_in(spark, rows).collect())) == wanted


def test_languages_without_terms(spark):
    rows = [("rare words", "en", "a"), (None, "en", "b"), ("x", "fr", "only")]
    assert sorted(map(tuple, found_in(spark, rows).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_empty_table(spark):
    assert found_in(spark, []).collect() == []


def test_shares_are_exact():
    rng = random.Random(1)
    for total, terms in ((0, 1), (5, 3), (10**9, 10**6), (9 * 10**14, 10**7)):
        counts = [0, 1, total, *(rng.randint(0, total) for _ in range(20))]
        got = divergence.shares(np.array(counts), np.array(total), terms)
        assert got.tolist() == [1 + 10**9 * (n + 2) // (total + 2 * terms) for n in counts]


def test_stripes_of_a_task():
    held = divergence.Stripes()
    for text, lang, source in ((b"B b a", "x", "s"), (b"b", "x", "t"), (b"", "x", "u"), (b"a", "y", "s")):
        held.add(text, lang, source)
    assert held.size == 4
    got = [(r["lang"], r["term"], r["documents"], dict(zip(r["sources"], r["counts"], strict=True))) for b in held.sent() for r in b.to_pylist()]
    assert sorted(got, key=str) == [("x", "a", 1, {"s": 1}), ("x", "b", 2, {"s": 2, "t": 1}), ("y", "a", 1, {"s": 1})]


def test_stripes_are_shuffled_once(spark):
    """Both groupings use the one exchange by language and term."""
    docs = h.frame(spark, [(1, "a", "en", "s", 0)]).select("text", "lang", "source")
    plan = divergence.stripes(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_query_equals_sql(spark, folder, tmp_path):
    import duckdb

    path = f"/root/testdata/{folder}"
    sql = divergence.SQL.replace("FROM documents", f"FROM '{path}/documents.parquet'")
    h.same_rows(found := divergence.op13_source_divergence(spark, path), found.columns, duckdb.sql(sql).fetchall())
