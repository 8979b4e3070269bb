"""Similarity join of documents by the Jaccard coefficient of their word n-gram sets, filtered by several global orders.

With n grams, two documents that reach the similarity share a gram among the first n - ceil(t * n) + 1 of each, in any
order of grams that all documents follow. Three orders are used. All put rare grams first (by how many units of
documents hold them, counted over the whole corpus); among equally frequent ones each order is another
permutation. A document whose prefix holds only grams of its own, in any of the orders, has no partner and drops out at once.

Candidates come from the first order; length and position bounds are part of the key they meet on. Then they must share a prefix
gram under the second and the third order too, and only for the pairs left are whole sets fetched and compared. Equal sets are one class from the start. A frequent
prefix gram does not make all pairs of its documents: first each is compared with the one that has the gram
earliest in its order, and classes that turn out linked are joined into components. Then only documents
of different components are paired, and of these only with at least one outside the largest component of the gram. No
link between different texts is lost by this: a pair left out is in one component already.

The place of a gram in the order bounds the size of a partner: with n grams and the first shared one at place p, a partner of m >= n grams
needs (t + 1) / t * (n - p) >= n + m. So the smaller document asks the few size bands from its own to that bound, and the larger
one waits in its own band. Forms that share their boilerplate have what is their own at the head of the order; where that is too
much for the similarity, the bound is below their size, they ask nobody, and however many there are, no pairs are made.

Defined results: null or empty text, or no word: no grams, linked with nothing, component its own doc_id; fewer words than n:
the whole sequence is the one gram; rows with equal sets are linked; rows of one doc_id count as documents of their own,
component and smallest doc_id come from all linked rows; a null doc_id is the smallest; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidespan.llm.components import components
from tidespan.llm.exchange import ANSWERED, SENT, SLICE_BYTES, Told, answered, codes, count_of, received, sent, with_units
from tidespan.llm.tables import prepared, spread_join, texts_of, total_bytes, written
from tidespan.llm.texts import U64, Words, mix, rolling, text_parts

#: Permutations of equally frequent grams; one order each.
SALTS = (0x51ED2701, 0x7FEB352D, 0x846CA68B)
SETS = "doc_id long, n int, sig binary, grams binary, tokens array<long>, places array<int>, prefix2 array<long>, prefix3 array<long>"
#: Size bands in a factor of e.
BANDS = 40



def gram_sets(column: pa.ChunkedArray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct grams of every text; a text with fewer words has its whole sequence as the one gram."""
    for _, data, offsets in text_parts(column):
        found = Words(data, offsets, lower=True)
        whole = rolling(found.hash, words, 3)
        for i in range(len(offsets) - 1):
            s = found.of(i)
            n = s.stop - s.start
            if n >= words:
                yield np.unique(whole[s.start:s.stop - words + 1])
            else:
                yield rolling(found.hash[s], n, 100 + n) if n else np.empty(0, U64)


def grams_sent(unit: int, table: pa.Table, words: int, slices: int) -> pa.Table:
    code = np.sort(codes(np.concatenate([np.empty(0, U64), *gram_sets(table.column("text"), words)]), slices))
    last = np.append(code[1:] != code[:-1], True) if len(code) else np.empty(0, bool)
    first = np.append(True, last[:-1])[:len(code)]
    return sent(unit, code[last], ~(first & last)[last])


def gram_classes(slice_: int, table: pa.Table) -> pa.Table:
    """Grams that more than one document may hold, with the binary logarithm of how many units and repeats."""
    key, unit, flags, starts = received(table)
    if not len(key):
        return answered(slice_, key, unit, flags)
    holders = np.add.reduceat(1 + flags.astype(np.int64), starts)
    grade = np.minimum(np.log2(holders).astype(np.int64) + 1, 255)
    grade[holders < 2] = 0
    grade = np.repeat(grade, np.diff(np.append(starts, len(key))))
    return answered(slice_, key[grade > 0], unit[grade > 0], grade[grade > 0])


def prefixes(grams: np.ndarray, grade: np.ndarray, tenths: tuple[int, int]) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """For each order the shared grams of the prefix and their places in it; None if some order has none."""
    n = len(grams)
    size = n + (-n * tenths[0] // tenths[1]) + 1  # n - ceil(t * n) + 1
    if np.count_nonzero(grade == 0) >= size:
        return None
    out = []
    for salt in SALTS:
        order = np.lexsort((mix(grams ^ U64(salt)), grade))[:size]
        shared = np.flatnonzero(grade[order] > 0)
        if not len(shared):
            return None
        out.append((grams[order[shared]], shared))
    return out


def described(texts: pa.Table, told: pa.Table, words: int, tenths: tuple[int, int], slices: int) -> pa.Table:
    """Every document with the size and signature of its set; those that may have a partner with prefixes and set."""
    grades = Told(told, slices)
    n, sig, sets, tokens, places, p2, p3 = [], [], [], [], [], [], []
    seen = set()
    for doc_id, grams in zip(texts.column("doc_id").to_pylist(), gram_sets(texts.column("text"), words)):
        raw = grams.astype("<u8").tobytes()
        n.append(len(grams))
        sig.append(xxhash.xxh3_128_digest(raw) if len(grams) else None)
        found = prefixes(grams, grades.grades(grams), tenths) if len(grams) and (doc_id, sig[-1]) not in seen else None
        seen.add((doc_id, sig[-1]))
        sets.append(raw if found else None)
        tokens.append(found[0][0].astype(np.int64) if found else None)
        places.append(found[0][1].astype(np.int32) if found else None)
        p2.append(found[1][0].astype(np.int64) if found else None)
        p3.append(found[2][0].astype(np.int64) if found else None)
    return pa.table({
        "doc_id": texts.column("doc_id"), "n": pa.array(n, pa.int32()), "sig": pa.array(sig, pa.binary()), "grams": pa.array(sets, pa.binary()),
        "tokens": pa.array(tokens, pa.list_(pa.int64())), "places": pa.array(places, pa.list_(pa.int32())), "prefix2": pa.array(p2, pa.list_(pa.int64())), "prefix3": pa.array(p3, pa.list_(pa.int64())),
    })


def _common(a: bytes, b: bytes) -> int:
    both = np.concatenate([np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def verified(pairs: DataFrame, sets: DataFrame, tenths: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of signatures that share a prefix gram in the other orders and reach the similarity."""
    def both(pairs: DataFrame, *columns: str) -> DataFrame:
        side = lambda x: sets.select(F.col("sig").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns])
        return pairs.join(side("a"), "a").join(side("b"), "b")

    left = both(pairs, "prefix2", "prefix3").where("arrays_overlap(prefix2_a, prefix2_b) AND arrays_overlap(prefix3_a, prefix3_b)").select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("grams_a"), batch.column("grams_b")
            inner = np.array([_common(x[i].as_py(), y[i].as_py()) for i in range(batch.num_rows)], np.int64)
            sizes = batch.column("n_a").to_numpy().astype(np.int64) + batch.column("n_b").to_numpy()
            linked = np.flatnonzero(tenths[1] * inner >= tenths[0] * (sizes - inner))
            yield batch.take(pa.array(linked)).select(["a", "b"])

    return both(left, "n", "grams").mapInArrow(run, "a binary, b binary")


def _close(a: str, b: str, tenths: tuple[int, int]) -> str:
    """Bounds on sizes and places: the shared grams from the place on must be enough."""
    t, u = tenths
    need = f"ceil({t} * ({a}.n + {b}.n) / {t + u})"
    return f"{u} * least({a}.n, {b}.n) >= {t} * greatest({a}.n, {b}.n) AND {a}.n - {a}.place >= {need} AND {b}.n - {b}.place >= {need}"


def meetings(held: DataFrame, tenths: tuple[int, int]) -> DataFrame:
    """Distinct pairs (a, b) of postings (gram, place, sig, n, component, major) of one gram and different components that pass the bounds.

    The smaller by (n, sig) asks the bands of the sizes its place allows, the larger waits in its own; two of the major component never meet.
    """
    t, u = tenths
    band = "cast(floor(ln({n}) * %d) AS int)" % BANDS
    most = f"least((n - place) * {t + u}L div {t}L - n, n * {u}L div {t}L)"
    asking = held.withColumn("most", F.expr(most)).where("most >= n").selectExpr("*", f"explode(sequence({band.format(n='n')}, {band.format(n='most')})) AS band")
    waiting = held.withColumn("band", F.expr(band.format(n="n")))
    on = F.expr("p.gram = q.gram AND p.band = q.band AND p.component <> q.component AND struct(p.n, p.sig) < struct(q.n, q.sig) AND " + _close("p", "q", tenths))
    sides = (asking.where("NOT major"), waiting), (asking.where("major"), waiting.where("NOT major"))
    some, more = (p.alias("p").join(q.alias("q"), on).select(F.least("p.sig", "q.sig").alias("a"), F.greatest("p.sig", "q.sig").alias("b")) for p, q in sides)
    return some.union(more).distinct()


def linked_documents(docs: DataFrame, words: int = 4, tenths: tuple[int, int] = (85, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row. ``tenths``: the similarity as a fraction."""
    return _linked(docs, words, tenths, id_col, text_col, False)


def _mark(text: Column) -> Column:
    """Tells the rows of one doc_id apart by their text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _linked(docs: DataFrame, words: int, tenths: tuple[int, int], id_col: str, text_col: str, marked: bool) -> DataFrame:
    """``linked_documents``, if ``marked`` with the mark of every row's text."""
    prepared(docs.sparkSession)
    total = total_bytes(docs, text_col)
    slices = count_of(total, SLICE_BYTES)
    texts, more = texts_of(docs, id_col, text_col), ["mark"] if marked else []
    units = with_units(texts.withColumn("mark", _mark(F.col("text"))) if marked else texts, total)

    def send(key, table):
        return grams_sent(key[0].as_py(), table, words, slices)

    def grade(key, table):
        return gram_classes(key[0].as_py(), table)

    def describe(key, texts, told):
        sets = described(texts, told, words, tenths, slices)
        return sets.append_column("mark", texts.column("mark")) if marked else sets

    grades = units.groupBy("unit").applyInArrow(send, SENT).groupBy("slice").applyInArrow(grade, ANSWERED)
    rows = written(units.groupBy("unit").cogroup(grades.groupBy("unit")).applyInArrow(describe, SETS + (", mark binary" if marked else "")), "gram-sets")

    classes = rows.where("sig IS NOT NULL").groupBy("sig").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("f"), F.count(F.lit(1)).alias("copies"))
    classes = classes.select("sig", "f.doc_id", "f.known", "copies")
    sets = written(_one_of_each(rows.where("grams IS NOT NULL"), classes), "classes")

    postings = sets.select("sig", "n", F.explode(F.arrays_zip("tokens", "places")).alias("x")).select("sig", "n", F.col("x.tokens").alias("gram"), F.col("x.places").alias("place"))
    lead = postings.groupBy("gram").agg(F.min(F.struct("place", "sig", "n")).alias("f"), F.count(F.lit(1)).alias("holders")).where("holders > 1")
    postings = written(spread_join(postings, lead, "gram", "holders", postings.count()).where("f IS NOT NULL").select("gram", "place", "sig", "n", "f"), "postings")

    star = postings.select("gram", F.struct("place", "sig", "n").alias("p"), "f").where("p.sig <> f.sig AND " + _close("p", "f", tenths))
    first = written(verified(star.select(F.col("f.sig").alias("a"), F.col("p.sig").alias("b")).distinct(), sets, tenths), "first-links")
    parts = written(components(first), "first-components")

    held = postings.drop("f").join(parts.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    largest = held.groupBy("gram", "component").count().groupBy("gram").agg(
        F.max(F.struct("count", "component")).alias("m"), F.sum("count").alias("holders"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    open_ = spread_join(held, largest, "gram", "holders", postings.count(), ["sig", "gram"]).where("m IS NOT NULL")
    held = written(open_.withColumn("major", F.expr("component = m.component")).drop("m", "parts"), "open-postings")
    pairs = meetings(held, tenths)
    second = written(verified(pairs, sets, tenths), "second-links")

    # the first components as stars, joined by the links between them
    whole = parts if second.isEmpty() else components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(second))
    named = whole.join(classes.withColumnRenamed("sig", "node"), "node")
    least = named.groupBy("component").agg(F.min(F.struct("known", "doc_id")).alias("f"))
    joined = whole.join(least, "component").select(F.col("node").alias("sig"), F.col("f.doc_id").alias("linked_id"), F.lit(True).alias("linked"))
    ids = classes.join(joined, "sig", "left").select("sig", "copies", F.when(F.col("linked"), F.col("linked_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return spread_join(rows.select("doc_id", "n", "sig", *more), ids, "sig", "copies", rows.count()).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), *more)


def _one_of_each(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """One row for each signature: that of its smallest doc_id."""
    first = classes.select(F.col("sig").alias("s"), F.col("doc_id").alias("d"))
    return sets.join(first, (F.col("doc_id").eqNullSafe(F.col("d"))) & (F.col("sig") == F.col("s")), "left_semi").drop("doc_id", "mark")


def one_of_each_group(docs: DataFrame, words: int = 5, tenths: tuple[int, int] = (8, 10), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that have the smallest doc_id of their own group; all columns as they were.

    Each row is judged by its own text, also where several have one doc_id; rows of one group that share its smallest
    doc_id all stay.
    """
    rows = _linked(docs, words, tenths, id_col, text_col, True).where("doc_id <=> component_id")
    kept = rows.select(F.col("doc_id").alias("__kept"), F.col("mark").alias("__mark")).distinct()
    return docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col("__kept")) & (_mark(F.col(text_col)) == F.col("__mark")), "left_semi")
