"""Quality network, language network, fingerprints, packing."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from odd_rows import no_docs, odd_docs  # noqa: F401
from headway.llm import bytesops, fingerprint, langid, packing, quality, queries
from headway.llm.common import crc_mod, table


def brute_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def test_shingles_match_brute_force():
    texts = ["a b c d e", "A B\tC d", "x", "", " ", "one two", "a b c d e", "é É é É", None]
    data, offsets = bytesops.flat(pa.array(texts))
    h, many = bytesops.text_shingles(data, offsets, 4, bytesops.Powers())
    seen = {}
    at = 0
    for t, m in zip(texts, many):
        words = brute_words(t)
        want = ([tuple(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4
                else [tuple(words)] if words else [])
        assert m == len(want)
        for x, y in zip(h[at:at + m], want):
            assert seen.setdefault(y, x) == x
        at += m
    assert len(set(seen.values())) == len(seen)


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    data, offsets = bytesops.flat(pa.array(["some words here " * 50, "and there " * 30]))
    whole, _ = bytesops.text_shingles(data, offsets, 3, bytesops.Powers())
    monkeypatch.setattr(bytesops, "STRETCH_BYTES", 7)
    parts, _ = bytesops.text_shingles(data, offsets, 3, bytesops.Powers())
    assert (whole == parts).all()


def numeric(f, w, i, e):
    old = w[i]
    w[i] = old + e
    up = f()
    w[i] = old - e
    down = f()
    w[i] = old
    return (up - down) / (2 * e)


def test_gru_gradients():
    rng = np.random.default_rng(0)
    m = langid.BiGRU(["a", "b", "c"], hidden=3)
    b = rng.integers(97, 102, (6, 5)).astype(np.uint8)
    size, y = np.array([6, 4, 6, 1, 3]), np.array([0, 1, 2, 0, 1])
    m.w = {k: v.astype(float) for k, v in m.w.items()}
    _, g = m.gradients(b, size, y)
    for k, w in m.w.items():
        i = tuple(rng.integers(0, s) for s in w.shape)
        if k == "x":
            i = (i[0], i[1], int(b[0, 0]))
        assert numeric(lambda: m.gradients(b, size, y)[0], w, i, 1e-2) == pytest.approx(g[k][i], abs=1e-4)


def test_gru_inference_is_the_trained_forward_pass():
    m = langid.BiGRU(["a", "b"], hidden=4)
    rng = np.random.default_rng(1)
    b, size = rng.integers(0, 256, (9, 4)).astype(np.uint8), np.array([9, 5, 1, 9])
    states, _ = m._states(m._both(b, size), keep=True)
    p = m._softmax(m._aligned(states, size)) * (np.arange(9)[:, None] < size)
    assert np.allclose(p.sum(1).T, m.position_sums(b, size), atol=1e-5)
    text = b[:, 0]
    got = m.document_probabilities(text, np.array([0, 9, 9]))
    assert np.allclose(got[0], m.position_sums(b[:, :1], size[:1])[0] / 9) and (got[1] == 0).all()


def test_cnn_gradients_and_blocks():
    rng = np.random.default_rng(0)
    m = quality.ByteCNN(dims=3, filters=4, hidden=3)
    data = rng.integers(97, 104, 300).astype(np.uint8)
    offsets = np.array([0, 120, 120, 133, 300])
    y = np.array([0.0, 1, 1, 0])
    m.w = {k: v.astype(float) for k, v in m.w.items()}
    m.learning = True
    _, g = m.gradients(data, offsets, y)
    for k, w in m.w.items():
        i = tuple(rng.integers(0, s) for s in w.shape)
        if k == "e":
            i = (int(data[5]), i[1])
        assert numeric(lambda: m.gradients(data, offsets, y)[0], w, i, 1e-4) == pytest.approx(g[k][i], abs=2e-4)
    a, _, _ = m.pooled(data, offsets, block=5)
    b, _, _ = m.pooled(data, offsets)
    assert np.allclose(a, b)
    alone = [m.scores(data[i:j], np.array([0, j - i]))[0] for i, j in zip(offsets[:-1], offsets[1:])]
    assert np.allclose(alone, m.scores(data, offsets))


def test_symbols_echo_brute_force():
    text = b"ab ab ab ab xyz The The The end" * 2
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, 20, len(text)])
    got = quality.symbols(data, offsets)
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        for i in range(lo, hi):
            echo = any(i - p - 3 >= lo and text[i - 3:i + 1] == text[i - p - 3:i - p + 1] for p in quality.ECHO)
            assert got[i] == int(data[i]) + 256 * echo


def test_quality_held_out(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    got = queries.op1_quality(spark, SF_CHECK).toPandas().set_index("doc_id")
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    truth = labels.toPandas().set_index("doc_id").quality
    held = got[got.held_out].join(truth, how="inner")
    assert (held.predicted == held.quality).mean() > 0.93
    assert ((got.score >= 0.5).astype(int) == got.predicted).all()
    assert all(got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.index])


def test_language_held_out(spark):
    got = queries.op8_language(spark, SF_CHECK).toPandas().set_index("doc_id")
    truth = table(spark, SF_CHECK, "documents").select("doc_id", "lang").toPandas().set_index("doc_id").lang
    held = got[got.held_out].join(truth)
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_networks_on_odd_rows(spark, odd_docs, no_docs):
    model = langid.train(odd_docs, sample=50, rounds=3)
    got = langid.predict(odd_docs.select("doc_id", "text", "score"), model).collect()
    assert len(got) == odd_docs.count() and got[0].asDict().keys() == {"doc_id", "text", "lang_pred", "score"}
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0.0)
    assert langid.train(no_docs) is None
    assert langid.predict(no_docs, None).count() == 0
    assert {r.lang_pred for r in langid.predict(odd_docs, None).collect()} == {"und"}
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (4, 0), (None, 1), (2, None)], "doc_id int, quality int")
    cnn = quality.train(odd_docs, labels, F.lit(True), rounds=2)
    got = quality.score(odd_docs.select("doc_id", "text", "score"), cnn).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.train(no_docs, labels, F.lit(True)) is None
    assert quality.train(odd_docs, labels.where("false"), F.lit(True)) is None
    assert {r.score for r in quality.score(odd_docs, None).collect()} == {0.5}


def test_training_sample_ignores_held_out_rows(spark):
    docs = table(spark, SF_CHECK, "documents")
    labels = table(spark, SF_CHECK, "labels")
    keep = crc_mod("doc_id", 3) != 1
    flipped = labels.withColumn("quality", F.when(keep, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (quality.train(docs, x, keep, sample=40, rounds=2) for x in (labels, flipped))
    assert all((a.w[k] == b.w[k]).all() for k in a.w)


def test_fingerprint_insert_delete_order():
    fp = fingerprint.Fingerprint().insert("one two three four", "five", "five")
    text = fingerprint.fingerprints(["five\none two three four\nfive"], bytesops.Powers())[0]
    assert fp.hex() == text
    assert fp.delete("five").hex() == fingerprint.fingerprints(["one two three four\nfive"], bytesops.Powers())[0]
    assert fp.insert("x").hex() != text


@pytest.fixture
def ranges(spark):
    """Sets how many ranges rows are dealt to."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {n: spark.conf.get(n) for n in names}

    def deal(number):
        spark.conf.set(names[0], str(number))
        spark.conf.set(names[1], "false")

    yield deal
    for n, v in before.items():
        spark.conf.set(n, v)


def test_edited_fingerprints_of_repeated_and_null_keys(spark, ranges):
    """Rows of one key and rows that repeat as a whole go to several ranges, and
    each row's neighbour is the next one's text; keys may be texts."""
    ranges(4)
    rows = [(None, "null one two three")] * 40 + [("b", "same four five six")] * 40 + [("a", f"x {i} y") for i in range(9)]
    docs = spark.createDataFrame(rows, "id string, text string").repartition(3)
    dealt = fingerprint.dealt_by_range(docs, "id", "text")
    parts = dealt.select(F.spark_partition_id().alias("p"), "id").distinct().collect()
    assert all(len({r.p for r in parts if r.id == k}) > 1 for k in (None, "b"))
    got = fingerprint.edited_fingerprints(docs, key="id").collect()
    assert len(got) == len(rows) and sum(r.near_next == 1.0 for r in got) == 39 + 39
    assert [r.id for r in got].count(None) == 40


@pytest.mark.parametrize("size", [1, 3, 40])
def test_edited_fingerprints_brute_force(spark, odd_docs, ranges, size):
    ranges(size)
    rows = odd_docs.where("doc_id <> 7")
    got = fingerprint.edited_fingerprints(rows).collect()
    low = -(1 << 63)
    ordered = sorted(((-(r.doc_id if r.doc_id is not None else low), r.text or "") for r in rows.collect()),
                     key=lambda x: x[0])
    want = []
    for i, (k, t) in enumerate(ordered):
        later = ordered[(i + 1) % len(ordered)][1]
        cut = len(t) // 3
        want.append((None if k == -low else -k, len(t),
                     hashlib.sha256((t[:len(t) - cut] + later[:cut]).encode()).hexdigest()))
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == sorted(want, key=str)
    by_text = {}
    for r, (k, t) in zip(sorted(got, key=lambda r: (-(r.doc_id if r.doc_id is not None else low), r.n_chars)),
                         sorted(ordered, key=lambda x: (x[0], len(x[1])))):
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len(set(by_text.values())) == len(by_text)


def test_fingerprint_edge_tables(odd_docs, no_docs):
    assert fingerprint.edited_fingerprints(no_docs).count() == 0
    one = fingerprint.edited_fingerprints(odd_docs.where("doc_id = 6")).first()
    assert one.near_next == 1.0 and one.n_chars == 9
    assert fingerprint.with_fingerprint(odd_docs).count() == odd_docs.count()


def test_likeness_tells_edits_from_strangers(spark):
    got = queries.op3_fingerprint(spark, SF_CHECK).toPandas()
    assert (got.near_edited > got.near_next).mean() > 0.97
    assert got.near_edited.median() > 0.4 and got.near_next.median() < 0.1


def plain_elements(text):
    """What the sketch counts, one by one."""
    for p in text.encode().split(b"\n"):
        words = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t\v\f\r]+", p)]
        n = len(words)
        if len(p) < 64 or n < 3:
            yield from (p[i:i + 4].lower() for i in range(max(len(p) - 3, min(len(p), 1))))
            continue
        for i, (start, _) in enumerate(words):
            run = words[min(i, n - 3):min(i, n - 3) + 3]
            if run[2][1] - run[0][0] > 64:
                after = words[i + 1][0] if i + 1 < n else len(p)
                yield from (p[k:k + 4].lower() for k in range(start, min(after, len(p) - 3)))
            elif i <= n - 3:
                yield tuple(p[a:b].lower() for a, b in run)


def exact_likeness(a, b):
    x, y = Counter(plain_elements(a)), Counter(plain_elements(b))
    dot = sum(n * y[k] for k, n in x.items())
    return dot / (sum(n * n for n in x.values()) + sum(n * n for n in y.values()) - dot)


def hanzi(n, seed):
    return "".join(map(chr, np.random.default_rng(seed).integers(0x4E00, 0x9000, n)))


@pytest.mark.parametrize("text, other", [
    ("to be or " * 40_000, "not now but " * 30_000),  # one run more often than 2**15 times
    ("z" * 100_000, "y" * 100_000),
    (hanzi(900, 1), hanzi(900, 2)),  # no space at all
    (f"{hanzi(300, 3)} {hanzi(300, 4)}", hanzi(600, 5)),
    (f"see also here: {hanzi(900, 6)} and so on", hanzi(900, 7)),  # words around a long one
    (" ".join(hanzi(20, 10 + i) for i in range(40)), hanzi(820, 8)),
])
def test_likeness_of_repeats_and_of_texts_without_words(text, other):
    cut = len(text) // 3
    edited = text[:len(text) - cut] + other[:cut]
    a, b, c = fingerprint.fingerprints([text, edited, other], bytesops.Powers())
    assert fingerprint.likeness(a, b) == pytest.approx(exact_likeness(text, edited), abs=0.12)
    assert fingerprint.likeness(a, b) > 0.35 and fingerprint.likeness(a, c) < 0.2
    assert fingerprint.Fingerprint().insert(*text.split("\n")).hex() == a


def test_sketch_elements_brute_force(monkeypatch):
    rng = np.random.default_rng(0)
    sizes = [1, 3, 8, 30, 63, 64, 65, 70, 200]
    texts = ["", " ", " " * 70, "x", "xyz", "a b", "W" * 64, "  " + "ab " * 30 + " "]
    texts += [" ".join("".join(rng.choice(list("abÄ"), rng.choice(sizes))) for _ in range(rng.integers(1, 9)))
              for _ in range(200)]
    for block in (7, 1 << 20):
        monkeypatch.setattr(bytesops, "BLOCK_BYTES", block)
        got = [[] for _ in texts]
        for h, at in fingerprint.elements([t.encode() for t in texts], bytesops.Powers()):
            for x, i in zip(h.tolist(), at.tolist()):
                got[i].append(x)
        for t, x in zip(texts, got):
            assert sorted(Counter(x).values()) == sorted(Counter(plain_elements(t)).values()), t


def test_differencing_is_a_partition():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 300):
        x = rng.integers(1, 2049, n)
        w = packing.pack(x)
        sums = np.bincount(w, x)
        assert len(w) == n and sums.max() <= 2048
    window, sums = packing.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(window, [8, 7, 6, 5, 4])) == [14, 16] and sorted(sums) == [14, 16]
    assert len(packing.pack(np.zeros(0, int))) == 0


def check_packing(docs, got, closing=1):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    left = {}
    for r in docs:
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, closing], "<u4")
        left.setdefault(r.doc_id, []).append(ids)
    spans = {}
    for r in got:
        assert any(len(ids) == r.doc_tokens and zlib.crc32(ids[r.start:r.start + r.length]) == r.ids_crc32
                   for ids in left[r.doc_id])
        spans[r.doc_id] = spans.get(r.doc_id, 0) + r.length
    assert spans == {k: sum(map(len, v)) for k, v in left.items()}
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    return 1 - sum(spans.values()) / (2048 * len(windows))


def test_packing_exact_and_tight(spark):
    got = queries.op7_packing(spark, SF_CHECK).collect()
    waste = check_packing(table(spark, SF_CHECK, "documents").select("doc_id", "text").collect(), got)
    assert waste < 0.02


def test_packing_odd_rows(odd_docs, no_docs):
    got = packing.pack_documents(odd_docs, queries.tokenizer_path(), group=5).collect()
    check_packing(odd_docs.select("doc_id", "text").collect(), got)
    assert packing.pack_documents(no_docs, queries.tokenizer_path()).count() == 0


def test_repeated_rows_spread_over_groups(spark):
    docs = spark.range(4000, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("word "), "id")).otherwise("the same text").alias("text"))
    got = packing.pack_documents(docs, queries.tokenizer_path(), group=200).toPandas()
    assert len(got) == 4000 and got.doc_id.isna().sum() == 2000
    assert (got.sequence_id // (1 << 20)).value_counts().max() < 400
    assert got.groupby("sequence_id").length.sum().max() <= packing.CAPACITY
