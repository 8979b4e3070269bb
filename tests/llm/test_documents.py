"""Sharding, chat formatting, n-gram join, quality rules, substring dedup and fingerprints against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tests.llm import brute
from tests.llm.conftest import make
from tidespan.llm import chat, components, ngram_join, order_minhash, quality, sharding, substring_dedup
from tidespan.llm.queries import BYTE_BPE
from tidespan.llm.texts import Words, rolling, text_parts


# --- sharding ---------------------------------------------------------------------------------------
def test_differencing():
    assert sharding.differencing([], 3) == [] and sharding.differencing([5], 3) == [0]
    sizes = [8, 7, 6, 5, 4]
    sums = Counter()
    for s, where in zip(sizes, sharding.differencing(sizes, 2)):
        sums[where] += s
    assert sorted(sums.values()) == [14, 16]  # the known result of the two-way method
    rng = random.Random(3)
    sizes = [rng.randint(1, 10**6) for _ in range(2000)]
    sums = [0] * 24
    for s, where in zip(sizes, sharding.differencing(sizes, 24)):
        sums[where] += s
    assert max(sums) - min(sums) < 100


def test_shards(odd, odd_rows):
    rows = sharding.sharded(odd, 5).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in odd_rows)
    shard_of, slots, sums = defaultdict(set), defaultdict(list), Counter()
    text_of = defaultdict(set)
    for d, t in odd_rows:
        text_of[d, len((t or "").encode()) + 8].add(t)
    for r in rows:
        slots[r.shard].append(r.slot)
        sums[r.shard] += r.size
        (t,) = text_of[r.doc_id, r.size]
        shard_of[t].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())
    assert max(sums.values()) >= sum(sums.values()) / 5


def test_shards_of_a_hot_group(spark):
    rng = random.Random(1)
    rows = [(i, "hot " * 50) for i in range(300)] + [(1000 + i, "w" * rng.randint(1, 40)) for i in range(600)]
    found = sharding.sharded(make(spark, rows), 4).groupBy("shard").sum("size").collect()
    sums = sorted(r[1] for r in found)
    assert sums[-1] == 300 * 208 and sums[-2] - sums[0] <= 150  # the group alone, the others (40 groups) even


# --- chat -------------------------------------------------------------------------------------------
TURNS = [
    (1, 0, "system", "You <|im_end|> are\\ \\<| \\\\<|"), (1, 1, "user", "\n\nhé 中文 <"), (1, 2, "assistant", "\nyes 😀\n"), (1, 3, "assistant", "again"),
    (2, 0, "assistant", None), (2, 1, None, "x"), (2, 1, "assistant", ""), (3, None, "assistant", "no turn"), (3, 0, "user", "<|im_sep|>assistant"),
    (None, 0, "assistant", "no id"), (None, 1, "user", "no id"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (5, 0, "assistant", "long é " * 3000),
]


def test_chat(spark, monkeypatch):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    path = public_tokenizers.path(BYTE_BPE)
    rows = chat.digests(chat.formatted(df, path)).collect()
    want = {}
    for conv in {t[0] for t in TURNS}:
        turns = sorted(((-1 if t[1] is None else t[1]), t[2] or "", t[3] or "") for t in TURNS if t[0] == conv)
        said = "".join(t for _, r, t in turns if r == "assistant")
        hashed = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        length = sum(33 + len(chat.escaped(r)) + len(chat.escaped(t)) for _, r, t in turns)
        want[conv] = (conv, len(turns), hashlib.sha256(hashed.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), length)
    assert {r.conv_id: tuple(r) for r in rows} == want
    monkeypatch.setattr(chat, "BLOCK_CHARS", 10)  # a block a turn, nothing changes
    assert {r.conv_id: tuple(r) for r in chat.digests(chat.formatted(df, path)).collect()} == want
    assert chat.digests(chat.formatted(df.limit(0), path)).count() == 0
    more = df.selectExpr("*", "1 AS block", "2 AS ids", "'x' AS formatted")
    assert {r.conv_id: tuple(r) for r in chat.digests(chat.formatted(more, path)).collect()} == want


def test_mask_by_binary_search():
    offsets = np.array([(0, 3), (3, 5), (5, 8), (8, 9), (8, 9), (9, 12)])
    loss, spans = chat.masked(offsets, [(4, 9, True), (9, 10, False)])
    assert loss.tolist() == [False, True, True, True, True, False] and spans == [(4, 9)]


def test_tokens_end_at_markers(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "\n ok")], "conv_id long, turn long, role string, text string")
    (r,) = chat.formatted(df, public_tokenizers.path(BYTE_BPE)).collect()
    assert r.formatted == "<|im_start|>assistant<|im_sep|>\n ok<|im_end|>\n"
    assert [(s.start, s.stop) for s in r.spans] == [(31, 35)] and sum(r.loss) == len(r.ids) - len([x for x in r.loss if not x])


# --- n-gram join ------------------------------------------------------------------------------------
def test_linked(spark, odd, odd_rows, renamed, none):
    want = Counter(brute.components(odd_rows, 4, 85, 100))
    assert Counter(map(tuple, ngram_join.linked_documents(odd, 4, (85, 100)).collect())) == want
    assert Counter(map(tuple, ngram_join.linked_documents(renamed, 4, (85, 100), "name", "body").collect())) == want
    assert ngram_join.linked_documents(none).count() == 0


def test_one_of_each_group(odd, odd_rows):
    kept = Counter((r.doc_id, r.text) for r in ngram_join.one_of_each_group(odd, 5, (8, 10)).collect())
    want = Counter((d, t) for (d, t), (_, _, c) in zip(odd_rows, brute.components(odd_rows, 5, 8, 10)) if d == c)
    assert kept == want


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, a), (6, a + " end"), (5, b), (3, b), (None, "c " + a), (None, "d e f g h i"), (7, None), (5, "")]
    got = Counter((r.doc_id, r.text) for r in ngram_join.one_of_each_group(make(spark, rows), 5, (8, 10)).collect())
    assert got == Counter((d, t) for (d, t), (_, _, c) in zip(rows, brute.components(rows, 5, 8, 10)) if d == c)
    rows = [r for r in rows if r[0] is not None]
    got = Counter((r.doc_id, r.text) for r in ngram_join.one_of_each_group(make(spark, rows), 5, (8, 10)).collect())
    assert got == Counter([(5, a), (3, b), (7, None), (5, "")])


def test_links_between_copies_of_copies(spark):
    rng = random.Random(2)
    rows, base = [], [f"w{i}" for i in range(90)]
    for i in range(150):  # a walk: only neighbours are similar
        base = list(base)
        base[rng.randrange(90)] = f"v{i}"
        rows.append((i, " ".join(base)))
    rows += [(500 + i, " ".join(rng.choice("abc") for _ in range(rng.randint(4, 14)))) for i in range(150)]
    got = ngram_join.linked_documents(make(spark, rows), 4, (85, 100)).collect()
    assert Counter(map(tuple, got)) == Counter(brute.components(rows, 4, 85, 100))


def test_components(spark):
    rng = random.Random(4)
    links = [(f"{rng.randrange(200):03}", f"{rng.randrange(200):03}") for _ in range(150)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a string, b string")).collect()}
    part = {x: x for ab in links for x in ab if ab[0] != ab[1]}
    for _ in range(300):
        for a, b in links:
            if a != b:
                part[a] = part[b] = min(part[a], part[b])
    assert got == part


# --- quality ----------------------------------------------------------------------------------------
def test_counts(odd, odd_rows, renamed, none):
    rows = quality.judged(odd, None).collect()
    want = Counter()
    for d, t in odd_rows:
        c = brute.counts(t)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        want[(d, *c, None, failed, not failed)] += 1
    assert Counter(map(tuple, rows)) == want
    assert Counter(map(tuple, quality.judged(renamed, None, 0.5, "name", "body").collect())) == want
    assert quality.judged(none, None).count() == 0
    assert Counter(r.doc_id for r in quality.passing(odd, None).collect()) == Counter(r.doc_id for r in rows if r.kept)


def test_held_out_accuracy(spark, tiny):
    """Fitted on even doc_ids of the labelled rows, judged on odd ones."""
    folder = tiny.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.judged(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = sum((r.probability >= quality.THRESHOLD) == bool(r.quality) for r in rows)
    assert right / len(rows) > 0.95
    assert all(r.kept for r in rows if r.quality and not r.base_failed and r.probability >= quality.THRESHOLD)
    off = np.mean([r.probability for r in rows]) - np.mean([r.quality for r in rows])
    assert abs(off) < 0.05  # calibrated


def test_labels_of_one_kind(spark, odd):
    one = spark.createDataFrame([(10, 1, 0), (11, 1, 0), (12, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(odd, one) is None and quality.fit(odd, one.limit(0)) is None


def test_scores_do_not_depend_on_the_batch(spark, tiny):
    docs, labels = spark.read.parquet(f"{tiny}/documents.parquet"), spark.read.parquet(f"{tiny}/labels.parquet")
    model = quality.fit(docs, labels)
    once = {r.doc_id: r.probability for r in quality.judged(docs, model).collect()}
    again = {r.doc_id: r.probability for r in quality.judged(docs.repartition(7), model).collect()}
    assert once.keys() == again.keys() and all(abs(once[d] - again[d]) < 1e-9 for d in once)


# --- substring dedup --------------------------------------------------------------------------------
@pytest.mark.parametrize("width", [20, 6])
def test_repeats(spark, odd, odd_rows, renamed, none, width):
    want = Counter((d, len(w), len(w) - len(k), " ".join(k)) for d, w, k in brute.repeats(odd_rows, width))
    pick = lambda df: Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect())
    assert pick(substring_dedup.without_repeats(odd, width)) == want
    assert pick(substring_dedup.without_repeats(renamed, width, "name", "body")) == want
    assert substring_dedup.without_repeats(none, width).count() == 0


def test_repeats_in_many_units(spark, odd_rows, monkeypatch):
    monkeypatch.setattr("tidespan.llm.exchange.UNIT_BYTES", 2000)
    monkeypatch.setattr("tidespan.llm.substring_dedup.SLICE_BYTES", 3000)
    want = Counter((d, len(w), len(w) - len(k), " ".join(k)) for d, w, k in brute.repeats(odd_rows, 20))
    got = substring_dedup.without_repeats(make(spark, odd_rows), 20)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == want


def test_deduplicated_texts(spark, renamed):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, f"A  first\n{passage}\n end "), (2, f"B\n{passage}\nother  end"), (3, None), (4, " as  it\nwas ")]
    got = {r.doc_id: r.text for r in substring_dedup.deduplicated(make(spark, rows), 20).collect()}
    assert got == {1: rows[0][1], 2: "B\nother  end", 3: None, 4: rows[3][1]}
    assert substring_dedup.deduplicated(renamed, 20, "name", "body").dtypes == renamed.dtypes


# --- fingerprints -----------------------------------------------------------------------------------
def test_edited(odd, odd_rows, renamed, none):
    rows = order_minhash.edited_fingerprints(odd).collect()
    order = sorted(((d, t or "") for d, t in odd_rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter()
    for (d, t), (_, following) in zip(order, order[1:] + order[:1]):
        cut = len(t) // 3
        want[d, len(t), hashlib.sha256((t[:len(t) - cut] + following[:cut]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    text = {d: t for d, t in order}
    prints = defaultdict(set)
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints[text[r.doc_id]].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert Counter(map(tuple, order_minhash.edited_fingerprints(renamed, "name", "body").collect())) == Counter(map(tuple, rows))
    assert order_minhash.edited_fingerprints(none).count() == 0


def test_one_document_follows_itself(spark):
    (r,) = order_minhash.edited_fingerprints(make(spark, [(9, "a b c d e f")])).collect()
    assert r.near_next == 1.0 and r.n_chars == 11


def test_fingerprint_sees_order_and_repeats(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    moved = words[300:] + words[:300]
    thirds = words[:400] + [f"x{i}" for i in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(moved)), (3, " ".join(thirds)), (4, "a b c " * 100), (5, "a b c " * 101), (6, "other words here " * 3)]
    df = make(spark, rows).withColumn("s", order_minhash.fingerprint("text"))
    a, b = df.selectExpr("doc_id AS x", "s AS a"), df.selectExpr("doc_id AS y", "s AS b")
    near = {(r.x, r.y): r.n for r in a.join(b, a.x <= b.y).withColumn("n", order_minhash.likeness("a", "b")).collect()}
    assert all(near[i, i] == 1 for i in range(1, 7))
    assert 0.5 < near[1, 3] < 0.85  # two thirds are left
    assert near[1, 2] < 0.95  # the same k-mers in another order
    assert near[4, 5] > 0.8 and near[4, 6] == 0 and near[1, 4] == 0


# --- words and hashes -------------------------------------------------------------------------------
def test_words_and_windows(odd_rows):
    import pyarrow as pa

    texts = [t for _, t in odd_rows]
    seen = {}
    for at, data, offsets in text_parts(pa.array(texts, pa.string()), 500):
        words = Words(data, offsets)
        for i in range(len(offsets) - 1):
            want = brute.WORD.findall(texts[at + i] or "")
            s = words.of(i)
            assert [data[a:b].tobytes().decode() for a, b in zip(words.starts[s], words.ends[s])] == want
            for k in (1, 3, 7, 20):
                for n, h in enumerate(rolling(words.hash[s], k).tolist()):
                    assert seen.setdefault((k, h), tuple(want[n:n + k])) == tuple(want[n:n + k])
    assert len({k for k, _ in seen}) == 4
