"""Conversation tries, BPE coding and hard negatives against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_CHECK, SF_SMALL
from pyspark.sql import functions as F

from odd_rows import no_docs, odd_docs  # noqa: F401
from headway.llm import bpe, negatives, prefixtrie, queries
from headway.llm.common import table

CHAT = "conv_id long, turn int, role string, text string, key string, node string, shard int, words string"
BPE_FILE = queries.tokenizer_path("byte_bpe_50k.json")


def plain_nodes(rows):
    """Every distinct prefix, counted one by one."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - c % 20, [])[:h] + said[h:]
    members, kids, out = defaultdict(list), defaultdict(list), {}
    for c, said in whole.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        ends = ",".join(map(str, sorted(c for c in members[p] if len(whole[c]) == len(p))))
        out[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]),
                  sum(out[k][5] for k in kids[p]) or 1,
                  (len(members[p]) - 1) * words + sum(out[k][6] for k in kids[p]),
                  hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def nodes(chats):
    found = prefixtrie.prefix_nodes(prefixtrie.rebuilt(chats), chats.count())
    return sorted((tuple(r)[:8] for r in found.collect()), key=str)


def plain_rows(chats):
    return [tuple(r) for r in chats.select("conv_id", "turn", "role", "text").collect()]


@pytest.mark.parametrize("size", [8192, 60])
def test_trie_on_the_table(spark, monkeypatch, size):
    monkeypatch.setattr(prefixtrie, "SHARD_TURNS", size)
    chats = table(spark, SF_SMALL, "conversations")
    assert nodes(chats) == plain_nodes(plain_rows(chats))


@pytest.mark.parametrize("size", [8192, 40, 3])
def test_trie_on_odd_rows_and_copies(spark, monkeypatch, size):
    monkeypatch.setattr(prefixtrie, "SHARD_TURNS", size)
    rnd = random.Random(5)
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", "tied"), (2, 0, "", None), (None, 0, "a", "b"),
            (3, 1, "user", "again"), (3, 1, "user", "again"), (40, 0, "user", "x " * 50_000), (-3, 0, "user", "below zero")]
    for c in range(60, 160):  # copies, and prefixes of one another
        for t in range(rnd.choice([1, 2, 5, 5, 5])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} é\tof {rnd.choice([0, 0, 0, t])}"))
    chats = spark.createDataFrame([(*r, "k", "n", 1, "w") for r in rows], CHAT)
    assert nodes(chats) == plain_nodes(plain_rows(chats))
    assert nodes(chats.where("false")) == []
    alone = chats.where("conv_id = 2")
    assert nodes(alone) == plain_nodes(plain_rows(alone))


def test_double_array_holds_all_sequences_and_no_others():
    rnd = random.Random(1)
    for _ in range(30):
        many = sorted({tuple(rnd.randrange(1, 12) for _ in range(rnd.randrange(0, 6))) for _ in range(200)})
        trie = prefixtrie.DoubleArray([np.array(s, int) for s in many])
        prefixes = {s[:d] for s in many for d in range(len(s) + 1)}
        state = {(): 1}
        for p in sorted(prefixes, key=len):
            if p:
                state[p] = trie.child(state[p[:-1]], p[-1])
                assert state[p] > 1
            for t in range(1, 13):
                assert bool(trie.child(state[p], t)) == (p + (t,) in prefixes)
        assert len(set(state.values())) == len(prefixes)


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE_FILE)
    t.no_padding()
    t.no_truncation()
    return t


def test_bpe_is_the_librarys(spark):
    docs = table(spark, SF_CHECK, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    lib = library()
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, BPE_FILE), BPE_FILE).collect()}
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        assert got[k].ids == lib.encode(t, add_special_tokens=False).ids
        assert got[k].text == t
    for r in queries.op12_bpe(spark, SF_CHECK).collect():
        ids, text = got[r.doc_id].ids, texts[r.doc_id]
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *digests)


def test_bpe_of_strange_texts(monkeypatch):
    """Repeats, white space, added tokens, characters younger than Python's table,
    and a trie that is begun anew."""
    rnd = random.Random(3)
    pieces = (["a" * k for k in range(1, 30)] + [" " * k for k in range(1, 12)]
              + list("abcdefghij \n\t\r-=_.,'éüñ中文😀՘꟎\U00010940\x85᠎\x1c　")
              + ["the ", "ing", "'ll", "<|endoftext|>", "<|endof", "\r\n", "-----", "1234"])
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(0, 50))) for _ in range(3000)]
    texts += ["", "x" * 20_000, "ab" * 10_000]
    lib = library()
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, np.int32).tolist() for x in bpe.Encoder(BPE_FILE).encode(texts)] == want
    monkeypatch.setattr(bpe, "TRIE_NODES", 50)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 70)
    small, decoder = bpe.Encoder(BPE_FILE), bpe.Decoder(BPE_FILE)
    got = [np.frombuffer(ids, np.int32).tolist() for i in range(0, len(texts), 100) for ids in small.encode(texts[i:i + 100])]
    assert got == want
    for ids in want[:500]:
        assert decoder.decode(np.array(ids, int)) == lib.decode(ids, skip_special_tokens=False)
    assert decoder.decode(np.array([-1, 10 ** 6])) == ""
    # Ids that cut a character in two.
    for ids in ([128], [195, 128, 64], want[5][::-1], want[9][::-1]):
        assert decoder.decode(np.array(ids, int)) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_on_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    lib = library()
    extra = odd_docs.withColumn("ids", F.lit("mine")).withColumn("key", F.lit("mine"))
    coded = bpe.encode(extra, BPE_FILE)
    assert coded.columns == ["doc_id", "ids"]
    want = sorted(((r.doc_id, lib.encode(r.text or "", add_special_tokens=False).ids) for r in extra.collect()), key=str)
    assert sorted(map(tuple, coded.collect()), key=str) == want
    assert bpe.encode(no_docs, BPE_FILE).count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [tuple(r) for r in bpe.decode(null, BPE_FILE).collect()] == [(1, [], "")]


def test_bpe_refuses_other_kinds():
    with pytest.raises(ValueError):
        bpe.Vocabulary(queries.tokenizer_path())


def plain_negatives(rows, positives=5, negatives_=3):
    """Every anchor against every row, in Python integers."""
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        r = (label, [math.floor(256 * x) for x in v])
        kept[i] = min(kept.get(i, r), r)
    out = []
    for a, (label, x) in kept.items():
        if a % 50:
            continue
        scores = {i: sum(p * q for p, q in zip(x, y, strict=True)) for i, (_, y) in kept.items()
                  if i != a and len(y) == len(x)}
        near = sorted((-s, i) for i, s in scores.items() if kept[i][0] == label)[:positives]
        for s, p in near:
            far = sorted((-t, i) for i, t in scores.items()
                         if kept[i][0] != label and 50 * -s <= 100 * t <= 95 * -s)[:negatives_]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(far)]
    return sorted(out)


VECTOR = "vec_id long, embedding array<double>, label int, id string, x string, windows string, dim string, n string"


@pytest.mark.parametrize("block,most", [(8192, 1024), (8192, 30), (16, 1024)])
def test_negatives_on_odd_rows(spark, monkeypatch, block, most):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "SEARCH_ROWS", most)
    rng = np.random.default_rng(4)
    near = rng.normal(size=12)
    rows = [(i, (rng.normal(size=12) + (near if i % 3 else 0)).tolist(), int(i % 4)) for i in range(300)]
    rows += [(400 + i, near.tolist(), i % 2) for i in range(20)]  # equal rows
    rows += [(500, [0.0] * 12, 0), (501, [float("nan")] * 12, 0), (502, [1.0] * 11 + [None], 0), (503, None, 0),
             (504, [1.0] * 12, None), (None, [1.0] * 12, 1), (550, [float("inf")] * 12, 1), (600, [1.0, 2.0], 0),
             (601, [1.0, 2.0], 0), (602, [0.9, 1.5], 1), (650, [], 2), (651, [], 2), (652, [], 3), (700, [-1.0] * 12, 9),
             (701, [1.0] * 12, 9), (7, [0.5] * 12, 0), (7, [0.5] * 12, 0), (800, (near * 1e7).tolist(), 1)]
    df = spark.createDataFrame([(*r, "i", "x", "w", "d", "n") for r in rows], VECTOR)
    got = sorted(map(tuple, negatives.hard_negatives(df, lambda k: k % 50 == 0).collect()))
    want = plain_negatives([(i, label, v) for i, v, label in rows])
    assert got == want and len(want) > 50
    assert negatives.hard_negatives(df.where("false"), lambda k: k % 50 == 0).count() == 0
    one = negatives.hard_negatives(df.where("vec_id = 50"), lambda k: k % 50 == 0)
    assert one.columns == [f.split(" ")[0] for f in negatives.RESULT.split(", ")] and one.count() == 0


def test_index_leaves_out_what_norms_cover():
    rng = np.random.default_rng(2)
    rows = rng.integers(-200, 200, size=(50, 32))
    block = negatives.Block(np.arange(50), np.zeros(50, int), rows)
    posted, rest = block.index(0.7)
    covered = sum(len(p) for p in posted) / (50 * len(posted))
    assert 0.2 < covered < 0.8 and np.abs(rest).sum() > 0
    anchors = rng.integers(-200, 200, size=(9, 32))
    norm = np.sqrt((anchors.astype(float) ** 2).sum(1))
    least = 0.7 * norm * block.top
    got = {tuple(map(int, x)) for x in zip(*block.reach((posted, rest), anchors, least), strict=True)}
    want = {(i, r, int(rows[r] @ anchors[i])) for i in range(9) for r in range(50)
            if rows[r] @ anchors[i] >= least[i]}
    assert got >= want and all(s == int(rows[r] @ anchors[i]) for i, r, s in got)
