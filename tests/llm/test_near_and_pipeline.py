"""Near-duplicates of texts and vectors, components, the corpus pipeline."""

import random

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_text_models import brute_words, check_packing

import corpus_pipeline
from odd_rows import no_docs, odd_docs  # noqa: F401
from headway.llm import e8, graph, lattice, minhash
from headway.llm.common import staged, table
from headway.llm.graph import components


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)]
    edges += [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(120)] + [(7, 7), (None, 3), (3, None)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == closure({x for e in real for x in e}, real)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("tail", [0, 4, 1024])
def test_components_however_many_edges_are_left(spark, monkeypatch, tail):
    monkeypatch.setattr(graph, "TAIL", tail)
    rng = random.Random(tail)
    edges = [(i, i + 1) for i in range(300, 380)] + [(5, i) for i in range(600, 640)]
    edges += [(rng.randrange(100), rng.randrange(100)) for _ in range(60)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = closure({x for e in edges if e[0] != e[1] for x in e}, edges)
    assert got == want


def shingle_set(text, width):
    w = brute_words(text)
    return ({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width
            else {tuple(w)} if w else set())


def brute_components(rows, width, percent=80):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k]
             if x and y and 100 * len(x & y) >= percent * len(x | y)]
    return closure({i for i, _ in sets}, links)


def noisy(words, rate, rng):
    return " ".join(w if rng.random() > rate else f"n{rng.randrange(10**6)}" for w in words)


@pytest.fixture(scope="module")
def groups():
    """Groups of near copies with rates around the threshold, exact copies, and
    a passage that all of one group share."""
    rng = random.Random(3)
    rows, i = [], 0
    for g in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(5, 400))]
        for _ in range(rng.randrange(1, 40)):
            rows.append((i, noisy(base, rng.choice([0, 0.002, 0.01, 0.02, 0.03, 0.05]), rng)))
            i += 1
    shared = [f"p{k}" for k in range(120)]
    for _ in range(40):
        rows.append((i, " ".join(shared + [f"q{rng.randrange(10**6)}" for _ in range(60)])))
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4, 2048])
def test_minhash_brute_force(spark, groups, block):
    docs = spark.createDataFrame(groups, "doc_id bigint, text string")
    got = minhash.near_duplicates(docs, width=4, block=block).collect()
    want = brute_components(groups, 4)
    assert {r.id: r.component_id for r in got} == want
    assert all(r.kept == (r.id == r.component_id) for r in got)
    size = {i: len(shingle_set(t, 4)) for i, t in groups}
    assert {r.id: r.n_shingles for r in got} == size


def test_crowded_keys_are_joined_in_rounds(spark):
    """One key of 95 members: 30 of one component, 60 that belong to it, five that are
    linked with nothing; rounds join the 60, and blocks are left for the rest."""
    rows = [(0, 0, i, 10, 0 if i < 30 else i, 0) for i in range(95)]
    placed = spark.createDataFrame(rows, "tag int, part bigint, rep bigint, n bigint, comp bigint, main bigint")

    def confirmed(pairs):  # all but the last five documents are linked with one another
        return pairs.where("a < 90 and b < 90")

    left, sizes, edges = minhash.crowds_joined(placed, confirmed, 80, 4)
    assert len(edges) >= 1
    comps = {r.rep: r.comp for r in left.collect()}
    assert {comps[i] for i in range(90)} == {0} and all(comps[i] == i for i in range(90, 95))
    (size,) = sizes.collect()
    assert size.rows == 2 and size.cols >= 24


def test_minhash_odd_rows(odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.id: (r.n_shingles, r.component_id, r.kept) for r in got}
    assert by[1][1:] == (1, True) and by[2][1:] == (1, False)
    assert by[3] == (0, 3, True) and by[4] == (0, 4, True) and by[5] == (0, 5, True)
    assert by[None][1:] == (None, True) and by[6] == (1, 6, True)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_signature_distance_guarantee():
    """Signatures that differ in up to 15 of 32 symbols share a key."""
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, (8, 4))
        b = a.copy()
        for k in rng.choice(32, 15, replace=False):
            b[k // 4, k % 4] ^= 1
        assert ((a != b).sum(1) <= 1).any()


def test_e8_is_the_nearest_point():
    r = e8.roots()
    assert r.shape == (240, 8) and np.allclose((r ** 2).sum(1), 2)
    x = np.random.default_rng(0).normal(size=(500, 8)) * 2
    c = e8.decode(x)
    d = ((x - c) ** 2).sum(1)
    assert d.max() <= 1 + 1e-9
    assert (((x[:, None] - c[:, None] - r[None]) ** 2).sum(2).min(1) >= d - 1e-9).all()


def brute_vectors(rows, threshold=0.95):
    unit = {k: lattice.unit(v) for k, v in rows}
    links = [(a, b) for a, _ in rows for b, _ in rows if a < b and unit[a] is not None and unit[b] is not None
             and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    n = {k: sum(k in e for e in links) for k, _ in rows}
    return n, closure({k for k, _ in rows}, links)


@pytest.mark.parametrize("block", [5, 256])
def test_vectors_brute_force(spark, block):
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for g in range(12):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 25))):
            rows.append((i, (base + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.2])).tolist()))
            i += 1
    rows += [(i + k, rows[3][1]) for k in range(7)]  # exact copies
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [None] + [1.0] * 15),
             (904, [float("nan")] * 16), (905, [float("inf")] * 16), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, n int, size string")
    got = lattice.near_vectors(df, block=block).collect()
    n, comp = brute_vectors(rows)
    found = {r.id: r.n_links for r in got}
    assert all(found[k] <= n[k] for k in n)
    assert sum(found.values()) >= 0.99 * sum(n.values())
    if found == n:
        assert {r.id: r.component_id for r in got} == comp
    assert all(r.kept == (r.id == r.component_id) for r in got)
    assert lattice.near_vectors(df.where("false")).count() == 0


def test_vector_rows_without_id_or_twice(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01])],
                               "vec_id bigint, embedding array<double>")
    got = sorted(((r.id, r.component_id) for r in lattice.near_vectors(df).collect()), key=str)
    assert got == [(1, 1), (1, 1), (2, 1), (None, None)]


def test_lattice_recall(spark):
    """Against brute force on the given table: at least 0.9 of all links."""
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding").collect()]
    n, _ = brute_vectors(rows)
    got = {r.id: r.n_links for r in lattice.near_vectors(table(spark, SF_SMALL, "embeddings")).collect()}
    assert all(got[k] <= n[k] for k in n) and sum(got.values()) >= 0.9 * sum(n.values())


def test_pipeline_stages(spark, odd_docs):
    """Each stage against a plain version of its decision, on its own input."""
    from headway.llm import secretscan
    from test_records import brute_spans

    docs = table(spark, SF_SMALL, "documents")
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, SF_SMALL), "pipeline-test")
        held[name] = (docs, out)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out
    before, after = (x.collect() for x in held["near_duplicates"])
    want = brute_components([(r.doc_id, r.text) for r in before], 5)
    assert {r.doc_id for r in after} == {k for k, v in want.items() if k == v}
    before, after = ({r.doc_id: r for r in x.collect()} for x in held["secrets"])
    assert before.keys() == after.keys()
    for k, r in before.items():
        assert (r.text == after[k].text) == (not brute_spans(r.text, secretscan.RULES))
        assert after[k].n_chars == len(after[k].text)
    before, after = (x.collect() for x in held["mixing"])
    words = lambda rows: sum(len(brute_words(r.text)) for r in rows)
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and len({r.doc_id for r in after}) == len(after)
    assert 0.8 * words(before) < words(after) <= 0.9 * words(before)
    before, after = (x.collect() for x in held["packing"])
    check_packing(before, after)
    assert len(held["language"][1].collect()) >= 0.97 * held["language"][0].count()


def test_pipeline_odd_rows(spark, odd_docs):
    extra = {c: f"mine {c}" for c in ("_domain", "_lang_pred", "_blob", "_spans", "_clean", "_tokens", "_copies",
                                      "rep", "n_shingles", "kept", "rules", "path", "suspect")}
    odd_docs = odd_docs.withColumns({c: F.lit(v) for c, v in extra.items()})
    extra |= {c: c for c in odd_docs.columns if c not in extra and odd_docs.schema[c].dataType.simpleString() == "string"
              and c not in ("text", "lang", "source")}
    for rows in (odd_docs, odd_docs.where("false")):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SF_SMALL), "pipeline-test")
            if name != "packing":  # the caller's own columns are as they were
                assert docs.columns == odd_docs.columns
                assert all(r[c] == v for r in docs.collect() for c, v in extra.items())
            if name == "near_duplicates":
                ids = [r.doc_id for r in docs.collect() if r.doc_id is not None]
                assert len(ids) == len(set(ids))
        assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@pytest.mark.parametrize("langs", [("de", "en", "es", "fr"), ("en", "fr")])
def test_pipeline_language_rejects_junk_and_foreign_texts(spark, langs):
    rng = np.random.default_rng(0)
    letters = lambda abc, n: "".join(rng.choice(list(abc), n))
    planted = [letters("abcdefghijklmnopqrstuvwxyz ", 600), letters("ABCDEFGHIJ0123456789+/", 900), "a" * 500,
               "x9!! zz## qq@@ kk%% " * 30, "Быстрая коричневая лиса перепрыгнула через ленивую собаку. " * 6,
               "我们今天去公园散步看见很多花和树木非常漂亮。" * 10,
               "Szybki brązowy lis przeskoczył nad leniwym psem i pobiegł do ciemnego lasu. " * 6,
               "Nopea ruskea kettu hyppäsi laiskan koiran yli ja juoksi metsään yöllä. " * 6]
    docs = table(spark, SF_SMALL, "documents").where(F.col("lang").isin(*langs)).select("doc_id", "text", "lang")
    more = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(planted)], docs.schema)
    got = {r.doc_id for r in corpus_pipeline.language(spark, docs.unionByName(more), SF_SMALL).collect()}
    assert not {k for k in got if k < 0}
    lettered = docs.where(F.col("text").rlike("\\p{L}")).count()
    assert len(got) >= 0.97 * lettered
