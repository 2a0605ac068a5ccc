import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import components as components_module
from ledgerlake.llm import bloom, decontaminate, langid, licenses, lines, minhash, mixing, quality, queries, substrings, tokens, urls
from ledgerlake.llm.components import components
from ledgerlake.llm.license_texts import TEMPLATES
from ledgerlake.llm.shared import documents as read_documents
from ledgerlake.llm.shared import written
from ledgerlake.llm.words import mix

from . import helpers as h

ITEM = "what is the colour of the sky above the port on a clear day in late spring"


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    rows = h.documents()
    near = ITEM.replace("port", "harbour").replace("late", "early")
    rows += [(900, f"x y, {ITEM.upper()}!", "en", "s1", 0), (901, f"so {near} z", "en", "s1", 0), (902, ITEM[:30], "en", "s1", 0)]
    items = [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "too short"), (None, "one two three four five six seven eight nine ten")]
    pages = [
        (1, "https://www.example.org/en/17"), (2, "http://EXAMPLE.org/es/1?x=1"), (3, "ftp://a.com/fr/"), (4, None), (5, "no scheme"),
        (6, "https://example.com/DE/"), (7, "https://adult-x.example.net/a"), (8, "https://example.net/adultery"), (9, "x://h.org?://b.com/de/"),
        (None, "https://a.com/de/casino"), (10, "https://b.net/Casino#x"), (10, "https://b.net/Casino#x"), (11, "://"), (12, "https://org/"),
        (13, "https://myexample.org/es/1"), (14, ""), (15, "https://bücher.net/a\nb"),
    ]
    return h.folder(spark, tmp_path_factory.mktemp("full"), rows, items, [(i, u, "") for i, u in pages])


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return h.folder(spark, tmp_path_factory.mktemp("empty"), [])


@pytest.mark.parametrize("name", queries.statements())
def test_queries_equal_sql(spark, full, name):
    columns, rows = h.by_sql(full, queries.statements()[name])
    found = queries.registered()[name](spark, full)
    assert found.columns == columns
    h.same_rows(found, columns, rows)


@pytest.mark.parametrize("name", queries.registered())
def test_empty_tables(spark, empty, name):
    assert queries.registered()[name](spark, empty).count() == 0


def test_near_duplicates_equal_sql(spark, full):
    columns, rows = h.by_sql(full, minhash.SQL)
    found = queries.registered()["op7_minhash_near_dedup"](spark, full)
    # NULL ids are never the smallest here, so components with other ids agree; repeated NULL rows are told apart below.
    h.same_rows(found, columns, rows)


def test_near_duplicates_of_a_chain_and_a_large_group(spark):
    """Members that reach each other only through others, and hundreds of near copies of one text with strays."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, base = [], [word() for _ in range(200)]
    for i in range(12):  # each differs from the next by a few shingles, the ends by many
        rows.append((i, " ".join(base)))
        base[i * 15 : i * 15 + 3] = [word() for _ in range(3)]
    base = [word() for _ in range(150)]
    for i in range(100, 400):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in ((d, t.split()) for d, t in rows)}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert found == {d: find(d) for d in sets}
    kept = minhash.keep_leaders(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(d) for d in sets})


def partly_linked_copies(n, seed=6):
    """Copies of one text, each with some words of its own: of two copies, many share tables and few are links."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(2, 5)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [4, 256])
def test_nodes_without_links_are_compared_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = partly_linked_copies(120)
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(116)} for d, t in rows}
    texts = spark.createDataFrame(rows, "node bigint, text string")
    keys = spark.createDataFrame([(k, d, d) for d, _ in rows for k in range(3) if (d + k) % 2], "key bigint, node bigint, label bigint")
    found = {(r.a, r.b) for r in minhash._block_links(keys, texts).collect()}
    linked = {(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert found <= linked

    def roots(links):
        root = {d: d for d in sets}
        for _ in sets:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return root

    share = {(a, b) for a, b in linked if any((a + k) % 2 and (b + k) % 2 for k in range(3))}
    assert roots(found) == roots(share | found) and len(found) < 20 * len(sets)


def test_rows_stay_linear_in_a_group_of_partial_copies(spark):
    """Rows that leave a comparison are links of a forest per pair of blocks: twice the copies do not make four times the rows."""
    made = {}
    for n in (150, 300):
        rows = partly_linked_copies(n)
        texts = spark.createDataFrame(rows, "node bigint, text string")
        keys = spark.createDataFrame([(k, d, d) for d, _ in rows for k in range(4)], "key bigint, node bigint, label bigint")
        made[n] = minhash._block_links(keys, texts).count()
    assert 0 < made[300] <= 2.5 * max(made[150], 100)


def test_pairs_of_one_table_are_not_dropped_by_minhashes(spark):
    """Two nodes that agree in the four minhashes of one table and in no others still get to the full sets."""
    one, other = list(range(48)), [k if k in (0, 1, 24, 25) else 100 + k for k in range(48)]
    sketch = spark.createDataFrame([(1, 100, one), (2, 75, other), (3, 74, other)], "node bigint, n_shingles bigint, minima array<int>")
    rows = spark.createDataFrame([(5, 0, 0, n, n) for n in (1, 2, 3)], "key bigint, i tinyint, j tinyint, node bigint, label bigint")
    pairs = {(r.a, r.b) for r in minhash._single_pairs(rows, sketch).collect()}
    assert pairs - {(2, 3)} == {(1, 2)}
    tried = spark.createDataFrame([(1, 2, 1), (1, 3, 1)], "a bigint, b bigint, node bigint")
    assert [(r.a, r.b, r.agreed) for r in minhash._rated(tried, sketch).collect()] == [(1, 2, 4)]


def test_one_of_equal_rows_stays_and_empty_texts_all(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "A B C"), (None, "a b c"), (2, None), (2, None), (3, ""), (None, "q"), (None, "q"), (None, "r")]
    kept = minhash.keep_leaders(h.frame(spark, rows, "doc_id bigint, text string"))
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    assert found[(2, None)] == 2 and found[(3, "")] == 1 and found[(None, "q")] == 1 and found[(None, "r")] == 1
    assert found[(1, "a b c")] + found[(1, "A B C")] == 1 and len(kept.columns) == 14


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 200, 2)] + [(rng.randrange(300), rng.randrange(300)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {x: find(x) for x in root if find(x) != x}


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_components_write_little(spark, monkeypatch, broadcast):
    """Finished stars take no round; a round over few nodes writes its edges and the smallest neighbours."""
    made = []
    monkeypatch.setattr(components_module, "BROADCAST_NODES", broadcast)
    monkeypatch.setattr(components_module, "written", lambda df: made.append(df) or written(df))
    stars = [(1, 5), (1, 7), (7, 1), (2, 3), (4, 4)]
    found = {r.node: r.root for r in components(spark.createDataFrame(stars, "a bigint, b bigint")).collect()}
    assert found == {5: 1, 7: 1, 3: 2} and len(made) == 2
    made.clear()
    found = {r.node: r.root for r in components(spark.createDataFrame([*stars, (5, 3)], "a bigint, b bigint")).collect()}
    assert found == {5: 1, 7: 1, 3: 1, 2: 1}
    rounds = (len(made) - 2) / (2 if broadcast else 4)
    assert rounds in (1, 2, 3)


def test_few_steps_for_near_duplicates(spark, monkeypatch):
    """What is known of a bucket is asked with the bucket, and known components are not sought again."""
    made = []
    for module in (minhash, components_module):
        monkeypatch.setattr(module, "written", lambda df: made.append(df) or written(df))
    docs = spark.createDataFrame(partly_linked_copies(40), "doc_id bigint, text string")
    minhash.near_duplicates(docs).collect()
    assert len(made) <= 45


def test_filters_never_miss():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000).astype(np.uint64)
    bits = bloom.bits_for(len(keys))
    parts = [bloom.partial_blocks(iter([part]), bits) for part in np.array_split(keys, 3)] + [bloom.partial_blocks(iter([keys[:700], keys[600:650]]), bits)]
    rows = sorted((b for part in parts for b in part), key=lambda b: b.column("block")[0].as_py())
    merged = {r["block"]: r for b in bloom._merge(iter(rows)) for r in b.to_pylist()}
    once, twice = (np.concatenate([bloom._open(merged[b][w]) for b in range(bits // bloom.BLOCK_BITS)]) for w in ("once", "twice"))
    assert bloom.contains(once, keys).all() and bloom.contains(twice, keys[:700]).all()
    assert bloom.contains(twice, keys[700:]).mean() < 0.05
    assert bloom.bits_for(10**15) == bloom.MAX_BITS


def test_saturated_filter_gives_the_same_rows(spark, full, monkeypatch):
    docs = read_documents(spark, full)
    before = [sorted(map(str, f(docs).collect())) for f in (lines.dedup_lines, substrings.dedup_substrings)]
    monkeypatch.setattr(bloom, "contains", lambda field, keys: np.ones(len(keys), bool))
    assert before == [sorted(map(str, f(docs).collect())) for f in (lines.dedup_lines, substrings.dedup_substrings)]


def test_texts_of_the_operators(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"p {shared} q"), (2, f"r  {shared}\ns t")], "doc_id bigint, text string")
    kept = {r.doc_id: r.kept_text for r in substrings.dedup_substrings(docs).collect()}
    assert kept == {1: f"p {shared} q", 2: "r s t"}
    line = "A line that is long enough\n"
    docs = spark.createDataFrame([(i, f"a\n{line}b") for i in range(3)], "doc_id bigint, text string")
    kept = {r.doc_id: r.kept_text for r in lines.dedup_lines(docs).collect()}
    assert kept == {0: "a\nb", 1: "a\nb", 2: f"a\n{line}b"}


def test_window_anchors_agree_in_all_copies():
    """Every window of one text has the anchor of its copies, whatever stands around them, also in periodic texts."""
    rng = random.Random(3)
    for vocabulary in ("ab", "abc", [f"w{i}" for i in range(50)]):
        for trial in range(60):
            core = [rng.choice(vocabulary) for _ in range(50)] if trial % 3 else [rng.choice(vocabulary) for _ in range(5)] * 10
            texts = [" ".join([*(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))), *core, *(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))]) for _ in range(4)]
            parsed = substrings.Parsed.of(h.text_array(texts))
            begin, _, names = parsed.anchors()
            plain = [tuple(w) for t in texts for w in _windows(t.split(" "), 50)]
            of, by = {}, {}
            for w, name, key in zip(plain, names.tolist(), parsed.keys(begin).tolist(), strict=True):
                assert of.setdefault(w, (name, key)) == (name, key)
                assert by.setdefault(key, w) == w


def _windows(words, size):
    return [words[i : i + size] for i in range(len(words) - size + 1)]


def test_symbol_names_reveal_and_verify():
    """Names of symbols, not places alone, make the names of anchors and the keys of windows."""
    texts = h.text_array([" ".join(f"w{i % 37}{i % 11}" for i in range(400))])
    parsed = substrings.Parsed.of(texts)
    begin, _, before = parsed.anchors()
    keys = parsed.keys(begin)
    parsed.names = mix(parsed.names)
    _, _, after = parsed.anchors()
    assert not set(before.tolist()) & set(after.tolist())
    assert not set(keys.tolist()) & set(parsed.keys(begin).tolist())


def test_policies_and_ablations_read_the_stored_ledger(spark, full):
    docs = read_documents(spark, full)
    stored = quality.stored_ledger(docs)
    for version in quality.POLICIES:
        rows = quality.kept_rows(stored, docs.columns, version).collect()
        passed = Counter(str(r.doc_id) for r in quality.ledger(docs).where(~quality.fails(version)).collect())
        assert Counter(str(r.doc_id) for r in rows) == passed
    assert sorted(map(str, quality.ablation(stored).collect())) == sorted(map(str, quality.ablation(quality.ledger(docs)).collect()))
    book = quality.ledger(docs).collect()
    kept = sorted(str(r.doc_id) for r in quality.keep_good(docs).collect())
    assert kept == sorted(str(r.doc_id) for r in book if r.failed_bits == 0)
    rejected = {v: sum(r.failed_bits & quality.mask(rules) != 0 for r in book) for v, rules in quality.POLICIES.items()}
    assert rejected[1] <= rejected[2] < len(book)
    for r in quality.ablation(quality.ledger(docs)).collect():
        bit = quality.mask((r.rule,))
        assert r.rejected == sum(bool(b.failed_bits & bit) for b in book)
        assert r.rejected_alone == sum(b.failed_bits == bit for b in book)
        assert r.kept_without == sum(b.failed_bits & ~bit == 0 for b in book)


def test_stages_keep_columns(spark, full):
    docs = read_documents(spark, full)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, full).columns == docs.columns, name


def test_stages_take_names_with_dots(spark, full):
    docs = read_documents(spark, full).withColumns({"a.b": F.lit("x"), "a_b": F.lit(1), "failed_bits": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = Counter((r.doc_id, r.text) for r in stage(spark, read_documents(spark, full), full).collect())
        kept = stage(spark, docs, full)
        assert kept.columns == docs.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == plain, name
        assert {(r["a.b"], r.a_b, r.failed_bits) for r in kept.collect()} == {("x", 1, 2)}, name


def test_texts_in_other_scripts_are_not_judged_by_their_latin_capitals(spark):
    words = "космический корабль летит над морем и землёй очень долго пока люди внизу смотрят вверх а дети спят дома у тёплой печи где"
    rows = [(1, f"{words} NASA"), (2, words), (3, words.upper()), (4, " ".join(f"LOUD{c}" for c in "ABCDEFGHIJKLMNOPQRSTUVWX"))]
    kept = quality.keep_good(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in kept} == {1, 2, 3}


def test_substituted_passages_are_found(spark):
    rng = random.Random(5)
    item = [f"t{i}" for i in range(40)]
    rows = []
    for i in range(30):
        w = list(item)
        w[rng.randrange(40)] = "other"
        rows.append((i, " ".join(["lead"] * (i % 5) + w)))
    rows.append((99, " ".join(item[:8] + ["else"] * 30)))
    found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string"))
    assert {(r.doc_id, r.n_agreeing, r.doc_token) for r in found.collect()} == {(i, 39, i % 5) for i in range(30)}


def test_masks_fit_every_accepted_pattern():
    """Whatever places of a frame are substituted, a mask lies between them as long as the rule accepts the rest."""
    for n in range(decontaminate.SPAN, decontaminate.FRAME + 1):
        for k in range(n + 1):
            if (n - k) * decontaminate.FRAME < decontaminate.LEAST * n:
                break
            for gone in itertools.combinations(range(n), k):
                fits = any(_fits(m, at, gone) for m in decontaminate.MASKS for at in range(n - len(m) + 1))
                assert fits, (n, gone)


def _fits(mask, at, gone):
    return mask[0] == mask[-1] == "1" and not any(at <= g < at + len(mask) and mask[g - at] == "1" for g in gone)


@pytest.mark.parametrize("broadcast", [decontaminate.BROADCAST_SEEDS, 0])
def test_contaminated_equals_the_rule_alone(spark, monkeypatch, tmp_path, broadcast):
    """All alignments of all pairs, place by place and without seeds; the SQL too."""
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", broadcast)
    rng = random.Random(9)
    items = {n: [f"i{n}t{k}" for k in range(n)] for n in (*range(2, 14), 16, 20, 40)}
    texts = {0: ["other"] * 4 + [t if k not in (4, 8) else "x" for k, t in enumerate(items[13])], 1: items[9][1:8], 2: items[13][3:], 3: items[8]}
    for i in range(4, 400):
        n = rng.choice(list(items))
        w = list(items[n])
        for k in rng.sample(range(n), rng.randint(0, min(5, n))):
            w[k] = rng.choice(["x", *items[n]])
        begin = rng.choice([0, 0, rng.randint(0, 3)])
        texts[i] = [f"y{i}"] * rng.choice([0, 0, 5]) + w[begin : n - rng.choice([0, 0, rng.randint(0, 3)])] + ["z"] * rng.choice([0, 7])
    texts |= {500 + n: ["y", *v, "z"] for n, v in items.items()}
    wanted = {}
    for i, w in texts.items():
        for n, v in items.items():
            frame = min(n, 13)
            for start in range(-n + 1, len(w) if n >= 3 else -n + 1):
                same = [0 <= start + k < len(w) and w[start + k] == v[k] for k in range(n)]
                frames = [k for k in range(n - frame + 1) if sum(same[k : k + frame]) * 13 >= 10 * frame]
                if frames and (n >= 9 or all(same)):
                    found = (sum(same), -start, n, frames[0], frames[-1] + frame - 1)
                    wanted[i, n] = max(wanted.get((i, n), found), found)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id bigint, text string")
    bench = spark.createDataFrame([(n, " ".join(v)) for n, v in items.items()], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.n_agreeing, -r.doc_token, r.n_item_tokens, r.first_token, r.last_token) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == wanted and {(0, 13), (1, 9), (2, 13), (3, 8)} <= set(found) and {n for _, n in found} == set(items) - {2}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    columns, rows = h.by_sql(tmp_path, decontaminate.SQL, ("documents", "benchmark"))
    h.same_rows(decontaminate.contaminated(docs, bench), columns, rows)
    kept = {r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()}
    assert kept == set(texts) - {i for i, _ in wanted}


def test_seeds_of_a_long_text_are_shuffled_without_it(spark, monkeypatch):
    """100,000 tokens carried by each of their seeds would be a hundred GB."""
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    item = [f"t{k}" for k in range(30)]
    long = [f"w{k}" for k in range(100_000)]
    docs = spark.createDataFrame([(1, " ".join([*long, *item, *long])), (2, " ".join(long))], "doc_id bigint, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")).collect()
    assert [(r.doc_id, r.n_agreeing, r.doc_token) for r in found] == [(1, 30, 100_000)]


def test_decontamination_runs_no_python(spark, full):
    for df in (decontaminate.op1_benchmark_decontamination(spark, full), corpus_pipeline.decontamination(spark, read_documents(spark, full), full)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_rule_patterns_equal_plain_comparison(spark):
    rng = random.Random(6)
    hosts = ["org", "example.org", "a.example.org", "myexample.org", "x.com", "com", "b-c.net", ""]
    rows = [(i, f"http://{rng.choice(hosts)}{rng.choice(['', '/'])}{rng.choice(['es/', 'en/1', 'en/12', 'fr/', 'fr', 'de/x', 'EN/1'])}") for i in range(300)]
    named = [r for r in urls.RULES if r.is_host]
    for r in urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect():
        fits = [x for x in named if (r.host == (p := x.name.partition("/"))[0] or r.host.endswith("." + p[0])) and r.path.startswith("/" + p[2])]
        best = max(fits, key=lambda x: len(x.name), default=None)
        assert (r.rule, r.verdict) == ((best.name, best.verdict) if best else (None, "allow"))


def test_rules_wait_under_their_rarest_token(spark):
    sites = spark.createDataFrame([("example.org/en/",)] * 3 + [("example.net/",)] * 2, "site string")
    rules = (urls.host_rule("block", "example.org/en/1"), urls.Rule("block", "any", "zz$", (), False))
    assert {r.name: r.token for r in urls.rule_index(sites, rules).collect()} == {"example.org/en/1": "en", "any": ""}


def test_tokens_equal_whole_texts(spark, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_tokenizer())
    odd = [
        "a <|endoftext|>b c<|startoftext|>", None, "", " \n", "İstanbul ΑΣ Σ's don't we'll", "éa \u0301b x\u2003y z\u200bq", "日本語 123 4.5 $$$ x<|endoftext|>y",
        "\x00a\x0bb\x1cc\x85d", "à́ ̧c ﬁ ǅ ẞ", "'S 'T it'S", "A_b<|x <<| ~~a!!B?? `^ [a]{b}\\ 5a a5", "x" * 3000, "!" * 500 + "Q",
    ]
    rows = [(i, t) for i, t in enumerate(odd)] + [(r[0], r[1]) for r in h.documents()[:40] if r[0] is not None and r[0] > 20] + [(None, "null id"), (5, odd[5])]
    docs = h.frame(spark, rows, "doc_id bigint, text string")
    tokens.write_tokens(docs, f"{tmp_path}/t")
    read = tokens.read_tokens(spark, f"{tmp_path}/t").orderBy("start").collect()
    assert [r.doc_id for r in read] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    at, texts = 0, {}
    for d, t in rows:
        texts.setdefault(d, []).append(plain.encode(t or "", add_special_tokens=False).ids + [tokens.END_ID])
    for r in read:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids in texts[r.doc_id]
        at += r.n_tokens
    sums = tokens.checksums(tokens.read_tokens(spark, f"{tmp_path}/t")).orderBy("start").collect()
    assert [s.ids_crc32 for s in sums] == [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in read]


def _cased(spec):
    spec["normalizer"]["normalizers"].pop()


def _added(spec):
    spec["added_tokens"].append({"id": 49408, "content": "world", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False})


def _truncating(spec):
    spec["truncation"] = {"direction": "Right", "max_length": 3, "strategy": "LongestFirst", "stride": 0}


@pytest.mark.parametrize("change, by_words", [(_cased, False), (_added, False), (_truncating, True), (lambda spec: None, True)])
def test_other_tokenizers_encode_whole_texts(tmp_path, change, by_words):
    from tokenizers import Tokenizer

    with open(tokens.default_tokenizer(), encoding="utf-8") as file:
        spec = json.load(file)
    change(spec)
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    plain, encoder = Tokenizer.from_file(str(path)), tokens.Encoder(str(path))
    plain.no_truncation()
    texts = ["Hello World", None, "", "helloworld World's end\n\nof it", "x" * 3000]
    ids, offsets = encoder.encode(h.text_array(texts))
    assert encoder.by_words == by_words
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(offsets)] == [plain.encode(t or "", add_special_tokens=False).ids + [tokens.END_ID] for t in texts]


def test_token_files_carry_dictionaries_and_indexes(spark, tmp_path):
    import pyarrow.parquet as pq

    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(50)], "doc_id bigint, text string")
    tokens.write_tokens(docs, f"{tmp_path}/t")
    group = pq.ParquetFile(next((tmp_path / "t").glob("part-*"))).metadata.row_group(0)
    assert all(group.column(k).has_column_index and group.column(k).has_offset_index for k in range(group.num_columns))
    ids = next(group.column(k) for k in range(group.num_columns) if group.column(k).path_in_schema.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings


def test_budgets_are_met():
    rng = np.random.default_rng(8)
    for _ in range(60):
        k = int(rng.integers(1, 12))
        lengths = rng.choice(np.arange(1, 40), k, replace=False)
        counts = rng.integers(1, 5, k)
        sums = {0}
        for length, n in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {s + length * c for s in sums for c in range(n + 1)}
        budget = int(rng.integers(0, lengths @ counts + 1))
        taken = mixing.fit_budget(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        best = min(abs(s - budget) for s in sums)
        assert abs(int(lengths @ taken) - budget) <= best + lengths.max()
    lengths, counts = np.array([3, 700, 90_000, 5_000_000]), np.array([10**9, 10**7, 10**5, 10**4])
    assert abs(int(lengths @ mixing.fit_budget(lengths, counts, 12_345_678_901)) - 12_345_678_901) <= 1


def _targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, total, capped = {n: i % 3 + 1 for i, n in enumerate(names)}, sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[n] for n in capped)
        share = {n: 3.0 * sizes[n] if n in capped else rest * weight[n] / sum(weight[m] for m in names if m not in capped) for n in names}
        more = {n for n in names if share[n] > 3 * sizes[n]} - capped
        if not more:
            return share
        capped |= more


def test_mix_meets_targets(spark, full):
    rows = mixing.op5_mixing(spark, full).collect()
    again = mixing.op5_mixing(spark, full).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    docs = read_documents(spark, full).select("doc_id", "text", "source").collect()
    sizes = Counter()
    for d in docs:
        sizes[d.source] += len(h.words(d.text))
    assert sorted(str((r.doc_id, r.size)) for r in rows) == sorted(str((d.doc_id, len(h.words(d.text)))) for d in docs)
    shares = _targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.target] += r.taken
    assert sorted(shares.values()) == pytest.approx(sorted(taken), rel=1e-9)
    # No subset need come nearer than half the longest document; here all but the source of the longest one do.
    longest = {t: max(r.size for r in rows if r.target == t) for t in taken}
    assert all(abs(t - n) <= longest[t] / 2 for t, n in taken.items())
    assert sum(abs(t - n) > 1 for t, n in taken.items()) <= 1
    mixed = mixing.take_mix(read_documents(spark, full)).collect()
    assert sum(len(h.words(r.text)) for r in mixed) == sum(r.taken for r in rows)


def test_caps_pass_on_what_is_above(spark):
    rows = [(i, "w " * 10, None, "abc"[i % 3], 0) for i in range(6)] + [(50 + i, "w " * 100, None, "d", 0) for i in range(5)]
    found = mixing.op5_mixing(spark, h.folder(spark, _new_folder(), rows)).collect()
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(t.split())
    assert {round(r.target, 6) for r in found} == {round(t, 6) for t in _targets(sizes).values()}


def _new_folder():
    import tempfile

    return tempfile.mkdtemp()


def test_languages_of_held_out_texts():
    from ledgerlake.session import build_session

    spark = build_session()
    found = langid.op8_language_id(spark, "/root/testdata/sf0.01")
    docs = read_documents(spark, "/root/testdata/sf0.01").select("doc_id", "lang")
    right = found.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert right[0] > 0.98 and right[1] > 100


def test_language_counts_equal_brute_force(spark, full):
    langs, logs = langid.train(read_documents(spark, full))
    assert langs == ["en", "fr"] and logs.shape == (langid.BUCKETS + 1, 2)
    rows = read_documents(spark, full).collect()
    learned = [r for r in rows if r.lang and r.text is not None and not (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)]
    n = Counter(r.lang for r in learned)
    assert logs[-1] == pytest.approx(np.log([n["en"] / len(learned), n["fr"] / len(learned)]), rel=1e-5)
    for r in langid.op8_language_id(spark, full).collect():
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und")
    texts = spark.createDataFrame([(1, None), (2, "12 !?"), (3, "é"), (4, "")], "doc_id bigint, text string")
    assert {r.doc_id for r in langid.predict(texts, langs, logs).collect() if r.lang_pred == "und"} == {1, 2, 4}


def test_languages_equal_plain_naive_bayes(spark, full):
    """Counts, predictions and scores again, n-gram by n-gram in Python numbers."""
    remembered = {}

    def bucket(gram):
        if gram not in remembered:
            value = len(gram)
            for c in gram:
                value = (value * (0x10FFFF + 2) + ord(c)) % 2**64
            remembered[gram] = int(mix(np.array([value], np.uint64))[0]) >> 49
        return remembered[gram]

    def fold(c):
        if ord(c) < 128:
            return c.lower() if c.isalpha() else " "
        return chr(ord(c) + 32) if 0xC0 <= ord(c) < 0xDF and ord(c) != 0xD7 else c

    def grams(text):
        text = "".join(map(fold, text or ""))
        return Counter(bucket(text[i : i + n]) for n in (1, 2, 3) for i in range(len(text) - n + 1))

    rows = read_documents(spark, full).collect()
    counts, n_docs = {}, Counter()
    for r in rows:
        if r.lang is not None and r.text is not None and (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 != 2):
            counts.setdefault(r.lang, Counter()).update(grams(r.text))
            n_docs[r.lang] += 1
    langs = sorted(counts)
    whole = {x: sum(counts[x].values()) + 0.5 * 2**15 for x in langs}
    wanted = []
    for r in rows:
        score = [math.log(n_docs[x] / sum(n_docs.values())) + sum(k * math.log((counts[x][b] + 0.5) / whole[x]) for b, k in grams(r.text).items()) for x in langs]
        best = max(range(len(langs)), key=lambda i: (score[i], -i))
        letters = any(c.isalpha() for c in r.text or "")
        wanted.append((str(r.doc_id), langs[best] if letters else "und", 1 / sum(math.exp(s - score[best]) for s in score) if letters else 0.0, abs(score[0] - score[1])))
    found = sorted((str(r.doc_id), r.lang_pred, r.score) for r in langid.op8_language_id(spark, full).collect())
    for (i, lang, score), (j, lang2, score2, apart) in zip(found, sorted(wanted), strict=True):
        assert i == j and (lang == lang2 and score == pytest.approx(score2, abs=2e-3) or 0 < apart < 1e-2)


def _whole_alignment(text, template):
    """Score, matches and first token of the best local alignment, without index and band."""
    best, above = (0, 0, 0), [(0, 0, -j) for j in range(len(text) + 1)]
    for token in template:
        row = [(0, 0, 0)]
        for j, t in enumerate(text, 1):
            s, m, b = above[j - 1]
            options = [(s + 2, m + 1, b) if t == token else (s - 1, m, b), (above[j][0] - 1, *above[j][1:]), (row[j - 1][0] - 1, *row[j - 1][1:]), (0, 0, -j)]
            row.append(max(options))
            if t == token:
                best = max(best, row[-1])
        above = row
    return best


def test_license_scan_equals_whole_alignment(spark):
    rng = random.Random(4)
    cut = lambda text: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", h.lower(text))
    parts = {n: cut(t) for n, t in TEMPLATES.items()}
    rows = []
    for i, name in enumerate(n for n in parts for _ in range(3)):
        tokens_of = list(parts[name])
        for _ in range(0 if i % 3 == 0 else max(1, len(tokens_of) // (12 if i % 3 == 1 else 4))):
            at = rng.randrange(len(tokens_of))
            tokens_of[at : at + 1] = rng.choice([["changed"], [], [tokens_of[at], "added"]]) or []
            tokens_of = tokens_of or ["gone"]
        rows.append((i, " ".join(["before"] * rng.randint(0, 5) + tokens_of + ["after"] * rng.randint(0, 5))))
    found = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        found.setdefault(r.doc_id, []).append((r.n_matched, r.license))
    n_found = 0
    for i, text in rows:
        wanted = []
        for name, template in parts.items():
            _, matched, _ = _whole_alignment(cut(text), template)
            if matched >= (len(template) if len(template) < licenses.NOTICE_TOKENS else licenses.MIN_COVERAGE * len(template)):
                wanted.append((matched, name))
        # Places that do not overlap the best are reported as well; the best one always is.
        got = found.get(i, [])
        assert bool(got) == bool(wanted) and (not wanted or max(m for m, _ in got) == max(m for m, _ in wanted)), (i, got, wanted)
        assert {n for _, n in got} <= {n for _, n in wanted}
        n_found += bool(got)
    assert len(parts) <= n_found < len(rows)


def test_license_places(spark):
    mit = TEMPLATES["MIT"].replace("free of charge", "free of any charge").replace("sell copies", "offer copies")
    rows = [
        (1, "Foo é. Released under the MIT License. Baz"), (2, mit + " q"), (3, None), (4, ""), (5, "released under the BSD License"),
        (6, "Released under the MIT License. Released under the MIT License."), (7, "a " * 9 + TEMPLATES["Apache-2.0"].lower()), (None, "Licensed under CC BY-NC 4.0"),
        (8, "This work is licensed under the GNU General Public License, version 2."),
    ]
    docs = h.frame(spark, rows, "doc_id bigint, text string")
    found = sorted((str(r.doc_id), r.license, r.start, r.end) for r in licenses.scan(docs).collect())
    assert found == [
        ("1", "MIT notice", 7, 37), ("2", "MIT", 0, len(mit) - 1), ("6", "MIT notice", 0, 30), ("6", "MIT notice", 32, 62),
        ("7", "Apache-2.0", 18, 18 + len(TEMPLATES["Apache-2.0"]) - 1), ("None", "CC-BY-NC-4.0 notice", 0, 27),
    ]
    mit_row = next(r for r in licenses.scan(docs).collect() if r.license == "MIT")
    assert mit_row.n_matched == mit_row.n_tokens - 1 and mit_row.coverage > 0.99


def test_license_lines_of_the_test_data(spark):
    found = licenses.op10_license_scan(spark, "/root/testdata/sf0.01").select("doc_id").distinct().collect()
    wanted = duckdb.sql("SELECT doc_id FROM '/root/testdata/sf0.01/documents.parquet' WHERE regexp_matches(text, '(?i)licensed under|released under the mit')").fetchall()
    assert {r.doc_id for r in found} == {d for (d,) in wanted}


def test_pipeline_equals_brute_force(spark, full):
    from tokenizers import Tokenizer

    docs = read_documents(spark, full)
    book = quality.ledger(docs).collect()
    good = Counter(str(r.doc_id) for r in book if r.failed_bits == 0)
    stage1 = corpus_pipeline.quality_rules(spark, docs, full)
    assert Counter(str(r.doc_id) for r in stage1.collect()) == good
    found = corpus_pipeline.run(spark, full).orderBy("start").collect()
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, set()).add(r.text)
    for r in found:
        assert any(r.ids == plain.encode(t or "", add_special_tokens=False).ids + [2] for t in texts[r.doc_id])
    assert {900, 901}.isdisjoint(r.doc_id for r in found)
    ids = [r.doc_id for r in found]
    assert max(Counter(ids).values()) <= 3 and found[-1].start + found[-1].n_tokens == sum(len(r.ids) for r in found)


def test_every_stage_equals_brute_force(spark, full):
    """The documents that each stage keeps, again without the package: SQL, sets of shingles, place by place, plain sums."""
    as_key = lambda r: (r.doc_id is None, r.doc_id, r.text)
    docs, sql = read_documents(spark, full), quality.SQL
    columns, book = h.by_sql(full, sql)
    good = Counter(r[columns.index("doc_id")] for r in book if r[columns.index("kept")])
    stage = corpus_pipeline.quality_rules(spark, docs, full)
    first = stage.collect()
    assert Counter(r.doc_id for r in first) == good and len(first) > 20

    sets = {}
    for r in first:
        w = h.words(h.lower(r.text))
        sets[as_key(r)] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets, key=lambda k: (k[0], k[1] or 0, k[2])), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(a), find(b)), key=lambda k: (k[0], k[1] or 0, k[2]))
            root[high] = low
    leaders = sorted(str(k[1]) for k in sets if root[k] == k)
    stage = corpus_pipeline.near_dedup(spark, written(stage), full)
    second = stage.collect()
    assert sorted(str(r.doc_id) for r in second) == leaders and len(second) < len(first)

    cut = lambda text: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", h.lower(text))
    items = [cut(r.text) for r in spark.read.parquet(f"{full}/benchmark.parquet").collect()]

    def leaks(text):
        w = cut(text)
        for v in items:
            n, frame = len(v), min(len(v), decontaminate.FRAME)
            for start in range(-n + 1, len(w) if n >= decontaminate.SHORTEST else -n + 1):
                same = [0 <= start + k < len(w) and w[start + k] == v[k] for k in range(n)]
                if (n >= decontaminate.SPAN or all(same)) and any(sum(same[k : k + frame]) * decontaminate.FRAME >= decontaminate.LEAST * frame for k in range(n - frame + 1)):
                    return True
        return False

    clean = [r for r in second if not leaks(r.text)]
    stage = corpus_pipeline.decontamination(spark, written(stage), full)
    third = stage.collect()
    assert sorted(map(as_key, third), key=str) == sorted(map(as_key, clean), key=str)

    sizes, longest, taken = Counter(), Counter(), Counter()
    for r in third:
        n = len(h.words(r.text))
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    stage = corpus_pipeline.mix_sources(spark, written(stage), full)
    fourth = stage.collect()
    assert max(Counter(map(as_key, fourth)).values()) <= 3 and set(map(as_key, fourth)) <= set(map(as_key, third))
    for r in fourth:
        taken[r.source] += len(h.words(r.text))
    for source, target in _targets(sizes).items():
        assert abs(taken[source] - target) <= longest[source], source

    last = corpus_pipeline.run(spark, full).orderBy("start").collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in fourth)
    at = 0
    for r in last:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens


def test_words_of_two_letters_in_a_pattern_are_told_apart(spark):
    """Two words of 1,024 letters that a sum of powers modulo 2^64 cannot tell apart, in words, lines, shingles and windows."""
    from tokenizers import Tokenizer

    one = "a"
    while len(one) < 1024:
        one += one.translate({97: 98, 98: 97})
    two = one.translate({97: 98, 98: 97})
    filler = " ".join(f"w{i}" for i in range(49))
    texts = [f"{one} {two} {one}", f"{one}\n{two}\n{one}", f"{one} x y z u", f"{two} x y z u", f"{filler} {one}", f"{filler} {two}"]
    texts += [f"{one}\n{two}"] * 3
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], h.SCHEMA)
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    for r in tokens.encoded(docs).collect():
        assert r.ids == plain.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
    path = h.folder(spark, _new_folder(), [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    for name in ("op2_quality_rules", "op6_line_dedup", "op7_minhash_near_dedup", "op9_substring_dedup"):
        columns, rows = h.by_sql(path, queries.statements()[name])
        h.same_rows(queries.registered()[name](spark, path), columns, rows)


def test_shared_names_of_texts():
    """Hashes do not depend on where a text lies in its batch."""
    texts = ["b c", None, "a b c", "", "é a"]
    for t in texts:
        alone = [hashlib.md5(x.tobytes()).hexdigest() for x in (minhash.shingle_sets(h.text_array([t]))[1],)]
        row, names, _ = minhash.shingle_sets(pa.array(texts))
        both = hashlib.md5(names[row == texts.index(t)].tobytes()).hexdigest()
        assert alone == [both]
