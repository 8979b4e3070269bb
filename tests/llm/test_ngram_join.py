"""The similarity join over many units and slices, on forms, and its dealing of frequent keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidespan.llm import exchange, ngram_join, tables

SCHEMA = "doc_id long, text string"


def varied(seed, n):
    """Texts of many lengths with copies of some of their words replaced, so that likeness lies on both sides of the limit."""
    deal = random.Random(seed)
    bases = [[f"w{deal.randrange(3000)}" for _ in range(deal.choice([3, 9, 30, 60, 120]))] for _ in range(n // 8)]
    common = [f"c{i}" for i in range(40)]
    rows = [(None, "a b c d"), (None, None), (7, ""), (7, "A b C d")]
    for i in range(n):
        words = list(deal.choice(bases))
        for _ in range(deal.choice([0, 0, 1, 1, 2, 4, 9])):
            words[deal.randrange(len(words))] = f"x{deal.randrange(500)}"
        at = deal.randrange(len(words) + 1)
        words = words[:at] + common[:deal.choice([0, 0, 40])] + words[at:]
        rows.append((1000 - i, " ".join(words[:deal.choice([len(words), len(words), len(words) - 2])])))
    return rows


@pytest.mark.parametrize("words,tenths", [(4, (85, 100)), (5, (8, 10)), (2, (1, 2))])
def test_many_units_and_slices(spark, monkeypatch, words, tenths):
    monkeypatch.setattr(exchange, "UNIT_BYTES", 2000)
    monkeypatch.setattr(ngram_join, "SLICE_BYTES", 9000)
    rows = varied(words, 400)
    got = ngram_join.linked_documents(spark.createDataFrame(rows, SCHEMA).repartition(5), words, tenths).collect()
    want = brute.components(rows, words, *tenths)
    assert Counter(map(tuple, got)) == Counter(want)
    assert len({c for _, _, c in want}) < 350  # there are groups


def test_forms_below_the_similarity_make_no_pairs(spark, monkeypatch):
    """200 words in common and 22 of their own: 197 of 241 four-word shingles, less than 85 %."""
    counted = []
    plain = ngram_join.verified

    def seen(pairs, sets, tenths):
        counted.append(pairs.count())
        return plain(pairs, sets, tenths)

    monkeypatch.setattr(ngram_join, "verified", seen)
    monkeypatch.setattr(exchange, "UNIT_BYTES", 100_000)
    shared = " ".join(f"clause{i}" for i in range(200))
    forms = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit(shared), *[F.concat(F.lit(f"f{i}n"), "id") for i in range(22)]).alias("text"))
    got = ngram_join.linked_documents(forms)
    assert got.where("doc_id = component_id AND n_shingles = 219").count() == 5000
    assert sum(counted) <= 5000


def test_sizes_that_may_meet_do(spark):
    """Every pair of postings that passes the bounds, and no other, whatever bands they are in."""
    deal = random.Random(3)
    rows = [(g, deal.randrange(1 + n // 6), f"{g}-{i}".encode(), n, f"{g}-{i % 37}".encode(), i % 37 == 0) for g in range(3) for i in range(150) for n in [deal.randrange(1, 400)]]
    held = spark.createDataFrame(rows, "gram long, place int, sig binary, n int, component binary, major boolean")
    want = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[2] < b[2] and a[4] != b[4]:
                need = -(-85 * (a[3] + b[3]) // 185)
                if 100 * min(a[3], b[3]) >= 85 * max(a[3], b[3]) and a[3] - a[1] >= need and b[3] - b[1] >= need:
                    want.add((a[2], b[2]))
    got = [(bytes(r.a), bytes(r.b)) for r in ngram_join.meetings(held, (85, 100)).collect()]
    assert len(want) > 300 and sorted(got) == sorted(want)


def test_spread_join(spark, tmp_path):
    """A left join; rows of a frequent key and rows without key are dealt over the partitions."""
    spark.range(6000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 2000) END AS k").write.parquet(f"{tmp_path}/big")
    big = spark.read.parquet(f"{tmp_path}/big")
    small = big.where("k IS NOT NULL AND k <> 'k5'").groupBy("k").agg(F.count(F.lit(1)).alias("copies"), F.max("id").alias("most"))
    got = tables.spread_join(big, small, "k", "copies", 6000)
    assert got.columns == ["id", "k", "most"]
    want = big.join(small.drop("copies"), "k", "left").select("id", "k", "most")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    moved = tables.spread_join(big.repartition(3), small, "k", "copies", 6000, ["id"])
    assert Counter(map(tuple, moved.collect())) == Counter(map(tuple, want.collect()))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sizes = sorted(r[0] for r in tables.spread_join(big, small, "k", "copies", 6000).select("most", F.spark_partition_id().alias("p")).where("most IS NULL OR most >= 0").groupBy("p").count().select("count").collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes[-1] < 2 * sizes[0] and len(sizes) > 1
