"""Sharding by histogram sort: shards of near-equal bytes in the order of a key.

The key of a row is (hash of its text, hash of its id): equal texts lie next to each other. The splitters
between the shards are found by counting the exact bytes below probes: all tasks count the rows of each probe
interval, the driver (at most PROBES numbers for each splitter) picks for every splitter the probe whose bytes
below come near enough to its target, or probes the interval that holds the target more finely. A text whose
copies outweigh the tolerance is split by the second hash. When all splitters stand, rows move once.

The law is `bytes`: a shard's bytes differ from the mean by at most the tolerance, or by one row where rows are
larger than it. A group of equal texts smaller than the tolerance is never cut.

Nulls: a null text has no bytes (its size is 1); null ids are alike. Repeated rows (same id and text) stay in
one shard and have slots of their own. Empty tables give an empty result. All columns of the input are kept;
the columns added replace those of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotebook.llm.staging import keep

PROBES = 512
#: Part of a shard's mean size by which a splitter may miss its target.
TOLERANCE = 0.005
#: Slots are numbered in lanes of about so many rows, so no task orders a whole shard.
LANE_ROWS = 16_384
KEY_END = 1 << 63


@dataclass
class Splitter:
    """Where one splitter may still lie: keys lo..hi-1, of the first hash or, below `text`, of the second."""

    target: float
    lo: int = 0
    hi: int = KEY_END
    text: int | None = None
    below: int = 0
    at: tuple[int, int] | None = None

    def zone(self) -> tuple:
        return (self.text, self.lo, self.hi)


def _half(*columns: str | Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def _counts(keys: DataFrame, zones: list[tuple], probes: int) -> dict[int, list]:
    """Exact bytes, least and greatest key of every probe interval that has rows, for each zone."""
    number, bin_ = F.lit(None).cast("int"), F.lit(None).cast("long")
    for i, (text, lo, hi) in enumerate(zones):
        key = F.col("k1") if text is None else F.col("k2")
        inside = (key >= lo) & (key <= hi - 1)
        if text is not None:
            inside &= F.col("k1") == text
        step = max(1, -(-(hi - lo) // probes))
        number = F.when(inside, F.lit(i)).otherwise(number)
        bin_ = F.when(inside, F.floor(F.expr(f"({'k1' if text is None else 'k2'} - {lo}L) div {step}L"))).otherwise(bin_)
    key = F.when(F.element_at(F.lit([z[0] is None for z in zones]), F.col("zone") + 1), F.col("k1")).otherwise(F.col("k2"))
    found = (
        keys.withColumn("zone", number)
        .withColumn("bin", bin_)
        .where("zone is not null")
        .groupBy("zone", "bin")
        .agg(F.sum("size").alias("size"), F.min(key).alias("least"), F.max(key).alias("most"))
        .collect()
    )
    out: dict[int, list] = {i: [] for i in range(len(zones))}
    for r in sorted(found, key=lambda r: (r.zone, r.bin)):
        out[r.zone].append((r.size, r.least, r.most))
    return out


def _refine(s: Splitter, bins: list, allowed: float) -> None:
    """Settle the splitter at a bin's edge, or narrow it to the bin that holds its target."""
    below = s.below
    for size, least, most in bins:
        if below + size >= s.target:
            break
        below += size
    before, after = s.target - below, below + size - s.target
    place = (lambda k: (k, 0)) if s.text is None else (lambda k: (s.text, k))
    alone = least == most
    if min(before, after) <= allowed or (alone and s.text is not None):
        s.at = place(least) if before <= after else place(most + 1)
    elif alone:
        s.text, s.lo, s.hi, s.below = least, 0, KEY_END, below
    else:
        s.lo, s.hi, s.below = least, most + 1, below


def find_splitters(
    keys: DataFrame, shards: int, tolerance: float = TOLERANCE, probes: int = PROBES
) -> list[tuple[int, int]]:
    """Splitters for `keys` (k1, k2, size): shard i ends before the i-th; at most one text is cut at each."""
    total = keys.agg(F.sum("size")).first()[0]
    if not total:
        return []
    allowed = tolerance * total / shards
    splitters = [Splitter(total * i / shards) for i in range(1, shards)]
    while open_ := [s for s in splitters if s.at is None]:
        zones = sorted({s.zone() for s in open_}, key=lambda z: (z[0] is not None, *[x or 0 for x in z]))
        bins = _counts(keys, zones, probes)
        for s in open_:
            _refine(s, bins[zones.index(s.zone())], allowed)
    return [s.at for s in splitters]


def shard_of(splitters: list[tuple[int, int]], k1: str = "k1", k2: str = "k2") -> Column:
    """The number of splitters at or below the key."""
    shard = F.lit(0)
    for text, ident in splitters:
        if text >= KEY_END:
            continue
        above = F.col(k1) > text
        if ident < KEY_END:
            above |= (F.col(k1) == text) & (F.col(k2) >= ident)
        shard = shard + above.cast("int")
    return shard


def assign_shards(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = TOLERANCE,
    lane_rows: int = LANE_ROWS,
) -> DataFrame:
    """`docs` with `size` (bytes of the text plus 1), `shard` (0 to shards-1) and `slot` (from 0, gapless)."""
    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long")
    keyed = docs.withColumn("size", size).withColumn("k1", _half(text_col)).withColumn("k2", _half(id_col))
    keys = keep(keyed.select("k1", "k2", "size"), "sharding-keys")
    splitters = find_splitters(keys, shards, tolerance)
    rows = keys.count()
    lanes = max(1, -(-rows // (shards * lane_rows)))

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("shard", shard_of(splitters)).withColumn("lane", F.pmod(F.xxhash64("k1", "k2"), F.lit(lanes)))

    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed(keys).groupBy("shard", "lane").agg(F.count("*").alias("n"))
        .select("shard", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    in_lane = F.row_number().over(Window.partitionBy("shard", "lane").orderBy("k1", "k2"))
    return (
        placed(keyed).withColumn("in_lane", in_lane.cast("long"))
        .join(bases, ["shard", "lane"])
        .withColumn("slot", F.col("base") + F.col("in_lane") - 1)
        .drop("k1", "k2", "lane", "in_lane", "base")
    )
