"""Order MinHash fingerprints, with DataFrame expressions only.

The k-mers of a text (k consecutive words) are numbered by occurrence, so a repeated k-mer counts as often as it
stands there. A hash of (k-mer, occurrence) deals them to ``bins``; of each bin the ``size`` minimal ones are selected,
put back into the order of the text, and hashed as one tuple. Equal slots of two fingerprints mean the same
minimal k-mers in the same order, which an edit breaks by changing or by moving words. A share f of equal slots estimates
the Jaccard coefficient of the numbered k-mers by f ** (1 / size), and 2 j / (1 + j) then follows the share of text
that is left as it was.

All work on a text is on primitive arrays inside one expression: places and hashes are packed into longs, so that sorts are
sorts of longs. Bits: 30 for the place, which is every place there is (a string holds less than 2^31 bytes, and a word with
the white space behind it takes two), 34 for the hash of a k-mer, of which the 6 upper ones tell the bin.

Defined results: null text: empty, whose fingerprint is that of one empty word; fewer than k words: one k-mer of all;
equal texts have equal fingerprints and likeness 1; rows go by descending doc_id, then text, null doc_ids last; a
table of one row is its own next document; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE_BITS = 30
PLACE = (1 << PLACE_BITS) - 1
BIN_BITS = 6
#: Ranges of rows in which the next document is looked up; only one text of each is sent across.
RANGES = 4096
#: Characters of a text that cut a range among rows of one doc_id.
PREFIX = 16


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def fingerprint(text: str, k: int = 3, size: int = 2) -> Column:
    """Slots of the text column as sorted distinct ints: 6 bits of bin, 26 bits of the tuple's hash."""
    high = 64 - BIN_BITS
    same = lambda c: f"coalesce(shiftrightunsigned(get(s, j - {c}) ^ x, {PLACE_BITS}) = 0, false)"
    far = f"aggregate(steps, 0, (c, b) -> if({same('(c + b)')}, c + b, c))"
    occurrence = f"CASE WHEN NOT {same(1)} THEN 0 WHEN NOT {same(2)} THEN 1 WHEN NOT {same(3)} THEN 2 ELSE {far} END"
    bin_of = lambda x: f"shiftrightunsigned({x}, {high})"
    value_bits = high - PLACE_BITS
    kmer = ", ".join(["x"] + [f"get(h, i + {d})" for d in range(1, k)])
    kmers = f"if(size(h) < {k}, array(xxhash64(h)), transform(slice(h, 1, greatest(size(h) - {k - 1}, 1)), (x, i) -> xxhash64({kmer})))"
    placed = f"sort_array(transform(m, (x, i) -> (x & {~PLACE}L) | i))"
    steps = "reverse(transform(sequence(0, cast(ceil(log2(size(s) + 1)) AS int)), e -> shiftleft(1, e)))"
    numbered = f"sort_array(transform(s, (x, j) -> (xxhash64(shiftrightunsigned(x, {PLACE_BITS}), {occurrence}) & {~PLACE}L) | (x & {PLACE}L)))"
    least = f"filter(z, (x, j) -> j < {size} OR {bin_of('x')} <> {bin_of(f'get(z, j - {size})')})"
    in_order = f"sort_array(transform({least}, x -> shiftleft({bin_of('x')}, {high}) | shiftleft(x & {PLACE}L, {value_bits}) | (shiftrightunsigned(x, {PLACE_BITS}) & {(1 << value_bits) - 1}L)))"
    tuple_hash = f"xxhash64(transform(filter(slice(o, j + 1, {size}), y -> {bin_of('y')} = {bin_of('x')}), y -> y & {(1 << value_bits) - 1}L))"
    slots = f"filter(transform(o, (x, j) -> if(j > 0 AND {bin_of('x')} = {bin_of('get(o, j - 1)')}, null, cast(shiftleft({bin_of('x')}, 26) + ({tuple_hash} & {(1 << 26) - 1}L) - 2147483648L AS int))), x -> x IS NOT NULL)"
    words = f"transform(split(trim(BOTH ' \\t\\n\\u000B\\f\\r' FROM {text}), '[ \\\\t-\\\\r]+'), x -> xxhash64(x))"
    body = _let("s", placed, _let("steps", steps, _let("z", numbered, _let("o", in_order, slots))))
    return F.expr(_let("h", words, _let("m", kmers, body)))


def likeness(a: str, b: str, size: int = 2) -> Column:
    """0 to 1, from two fingerprints."""
    slots = f"size(array_distinct(transform(concat({a}, {b}), x -> shiftrightunsigned(x ^ {-2**31}, 26))))"
    j = f"power(size(array_intersect({a}, {b})) / {slots}, 1D / {size})"
    return F.expr(_let("j", j, "2 * j / (1 + j)"))


def as_text(column: str) -> Column:
    return F.expr(f"array_join(transform({column}, x -> lpad(hex(x + 2147483648L), 8, '0')), '')")


def splitters(rows: DataFrame, ranges: int) -> list[tuple]:
    """At most ``ranges - 1`` keys that cut the order of the rows into parts of about equal numbers of keys.

    They come from a sample of some ``4 * ranges`` keys by hash, which is all that the driver sees.
    """
    wanted = max(rows.count() // (4 * ranges), 1)
    keys = rows.select("at.*").where(F.pmod(F.xxhash64("n", "d", "t"), F.lit(wanted)) == 0).distinct().orderBy("n", "d", "t").collect()
    return [tuple(keys[i * len(keys) // ranges]) for i in range(1, ranges)] if len(keys) > ranges else [tuple(k) for k in keys[1:]]


def with_part(rows: DataFrame, ranges: int) -> DataFrame:
    """``part``, which grows along the order of the rows: doc_id downwards, null ones last, then text."""
    at = F.struct(F.isnull("doc_id").cast("int").alias("n"), F.expr("coalesce(~doc_id, 0L)").alias("d"), F.left("text", F.lit(PREFIX)).alias("t"))
    rows = rows.withColumn("at", at)
    cuts = splitters(rows, ranges)
    steps = ", ".join(str(1 << i) for i in reversed(range(max(len(cuts), 1).bit_length())))
    bounds = F.from_json(F.lit(json.dumps([dict(zip("ndt", c)) for c in cuts])), "array<struct<n: int, d: bigint, t: string>>")
    search = F.expr(f"aggregate(array({steps}), 0, (c, b) -> if(coalesce(get(bounds, c + b - 1) <= at, false), c + b, c))")
    return rows.withColumn("bounds", bounds).withColumn("part", search).drop("at", "bounds")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, ranges: int = RANGES) -> DataFrame:
    """(doc_id, text, slots, next_text, next_slots): each document beside the one that follows by descending doc_id.

    Ranges of rows are sorted apart; the first document of a range is added behind the last one of the range before. A range
    ends at a quantile of (doc_id, beginning of the text), so neither far ids nor many rows of one id or without id make a
    large one; rows that agree in both stay in one range.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_part(rows, ranges)
    down = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    heads = rows.withColumn("__n", F.row_number().over(Window.partitionBy("part").orderBy(*down))).where("__n = 1").drop("__n")
    parts = rows.select("part").distinct()  # at most so many rows as there are ranges
    by_part = Window.orderBy("part")
    before = parts.select(F.col("part").alias("above"), F.coalesce(F.lead("part").over(by_part), F.first("part").over(by_part)).alias("part"))
    ghosts = heads.join(before, "part").select("doc_id", "text", F.col("above").alias("part"), F.lit(1).alias("ghost"))
    both = rows.select("doc_id", "text", "part", F.lit(0).alias("ghost")).union(ghosts)
    both = both.withColumn("slots", fingerprint("text", k))
    ahead = Window.partitionBy("part").orderBy("ghost", *down)
    return both.select(
        "doc_id", "text", "slots", "ghost", F.lead("text").over(ahead).alias("next_text"), F.lead("slots").over(ahead).alias("next_slots"),
    ).where("ghost = 0").drop("ghost")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3) -> DataFrame:
    """Fingerprints of every text and of its edited one (the last third replaced from the next document)."""
    rows = with_next(docs, id_col, text_col, k)
    third = "cast(floor(char_length(text) / 3) AS int)"
    rows = rows.withColumn("edited", F.expr(f"concat(left(text, char_length(text) - {third}), left(next_text, {third}))"))
    rows = rows.withColumn("edited_slots", fingerprint("edited", k))
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text("slots").alias("fingerprint"), as_text("edited_slots").alias("edited_fingerprint"),
        likeness("slots", "edited_slots").alias("near_edited"), likeness("slots", "next_slots").alias("near_next"),
    )
