"""Exact selection by rank: k rows per group, or the values at given ranks.

Everything here works on a histogram first. Rows are counted per group and
bucket of the key, a running sum over those few counts finds the bucket in
which the wanted rank falls, and only that bucket is looked at row by row. So
no step sorts the data, no task sees a whole group, and what is sent to every
executor is one line per group.

Order keys are hex hashes, so their first digits make even buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmix.functions.frames import compute_once, emit_copies, join_groups
from corpusmix.functions.text import row_digest
from corpusmix.session import materialize, pin_small

KEY_DIGITS = 3
VALUE_BUCKETS = 65_536
GATHERED_ROWS = 1_000_000

Quota = Callable[[DataFrame], DataFrame]


def fraction_quota(fraction: float) -> Quota:
    """The whole number of rows that does not exceed the fraction of each group."""

    def quota(counts: DataFrame) -> DataFrame:
        share = F.floor(F.col("available").cast("double") * F.lit(float(fraction)))
        return counts.withColumn("k", share.cast("bigint"))

    return quota


def fixed_quota(rows: int) -> Quota:
    """At most ``rows`` rows of each group."""

    def quota(counts: DataFrame) -> DataFrame:
        return counts.withColumn("k", F.least(F.lit(rows).cast("bigint"), F.col("available")))

    return quota


def _running(counts: DataFrame, groups: Sequence[str], order: str) -> DataFrame:
    """Add ``before`` and ``upto``: counts below this line and including it."""
    window = Window.partitionBy(*groups).orderBy(order)
    return counts.withColumn("upto", F.sum("n").over(window)).withColumn(
        "before", F.col("upto") - F.col("n")
    )


def key_bucket(order_key: str, digits: int = KEY_DIGITS) -> Column:
    return F.substring(F.col(order_key), 1, digits)


def _cuts(
    keyed: DataFrame, groups: Sequence[str], digits: int, wanted: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The bucket in which each group's rank falls: ``groups, bucket, k, n, skipped``.

    ``wanted`` adds the rank ``k`` to the running counts of the buckets, and
    ``base``, the rows known to lie below all of these buckets.
    """
    counted = keyed.groupBy(*groups, key_bucket("value", digits).alias("bucket")).agg(
        F.count("*").alias("n")
    )
    # The counts are used twice, for the sizes of the groups and for the sums, so the
    # small histogram is written and the keys are scanned only once.
    running = wanted(_running(materialize(counted, "key_histogram"), groups, "bucket"))
    rank = F.col("k") - F.col("base")
    hit = running.where((F.col("before") < rank) & (rank <= F.col("upto")))
    skipped = (F.col("base") + F.col("before")).alias("skipped")
    return pin_small(hit.select(*groups, "bucket", "k", "n", skipped))


def _inside(keyed: DataFrame, cuts: DataFrame, groups: Sequence[str], digits: int) -> DataFrame:
    """The rows in the cut buckets only."""
    bucketed = keyed.withColumn("bucket", key_bucket("value", digits))
    return join_groups(bucketed, cuts.select(*groups, "bucket"), [*groups, "bucket"], "left_semi")


def thresholds(
    df: DataFrame,
    quota: Quota,
    order_key: str = "order_key",
    groups: Sequence[str] = (),
    gathered_rows: int = GATHERED_ROWS,
) -> DataFrame:
    """The last key to take from each group: ``groups, k, value, before, at_value``.

    ``before`` counts the rows below that key, ``at_value`` those that have it.
    Groups with a quota of zero have no line; a quota above the rows of a group means
    all of them; null is a group like any other. One pass over the groups and keys
    makes the histogram; buckets with more than ``gathered_rows`` rows are divided
    once more, which is enough for any table: one key in 16 million is left.
    """
    groups = list(groups)
    # The key is often a hash still to be computed: filters must not compute it again.
    present = df.select(*groups, F.col(order_key).alias("_key"))
    keyed = compute_once(present, value=F.col("_key")).drop("_key")

    def clamped(counts: DataFrame) -> DataFrame:
        return counts.withColumn("k", F.least("k", "available"))

    def by_quota(running: DataFrame) -> DataFrame:
        based = running.withColumn("base", F.lit(0).cast("bigint"))
        if not groups:
            everything = F.sum("n").over(Window.partitionBy())
            return clamped(quota(based.withColumn("available", everything)))
        sizes = running.groupBy(*groups).agg(F.sum("n").alias("available"))
        wanted = join_groups(quota(sizes).select(*groups, "k"), sizes, groups)
        return join_groups(based, clamped(wanted).select(*groups, "k"), groups)

    digits = KEY_DIGITS
    cuts = _cuts(keyed, groups, digits, by_quota)
    if not cuts.where(F.col("n") > gathered_rows).isEmpty():
        ranks = cuts.select(*groups, "bucket", "k", F.col("skipped").alias("base"))
        inside = _inside(keyed, cuts, groups, digits).withColumnRenamed("bucket", "outer")
        digits *= 2

        def by_rank(running: DataFrame) -> DataFrame:
            outer = ranks.withColumnRenamed("bucket", "outer")
            return join_groups(running, outer, [*groups, "outer"])

        cuts = _cuts(inside, [*groups, "outer"], digits, by_rank).drop("outer")

    tallies = (
        _inside(keyed, cuts, groups, digits)
        .groupBy(*groups, "bucket", "value")
        .agg(F.count("*").alias("n"))
    )
    summed = _running(tallies, [*groups, "bucket"], "value")
    values = join_groups(summed, cuts.drop("n"), [*groups, "bucket"])
    rank = F.col("k") - F.col("skipped")
    found = values.where((F.col("before") < rank) & (rank <= F.col("upto")))
    return pin_small(
        found.select(
            *groups,
            "k",
            "value",
            (F.col("skipped") + F.col("before")).alias("before"),
            F.col("n").alias("at_value"),
        )
    )


def _with_threshold(df: DataFrame, limits: DataFrame, groups: Sequence[str], how: str) -> DataFrame:
    """Add the group's last key and counts; without groups these are literals."""
    names = {"_last": "value", "_k": "k", "_before": "before", "_tied": "at_value"}
    if groups:
        renamed = limits.select(*groups, *[F.col(old).alias(new) for new, old in names.items()])
        return join_groups(df, renamed, groups, how)
    line = limits.first()
    kinds = {new: limits.schema[old].dataType for new, old in names.items()}
    return df.select(
        "*", *[F.lit(line and line[old]).cast(kinds[new]).alias(new) for new, old in names.items()]
    )


def mark_first(
    df: DataFrame, quota: Quota, mark: str, order_key: str, groups: Sequence[str] = ()
) -> DataFrame:
    """Add a boolean column that is true for the first k rows of each group.

    Needs unique keys. No row moves: each is compared with its group's last key.
    """
    limits = thresholds(df, quota, order_key, groups)
    taken = F.coalesce(F.col(order_key) <= F.col("_last"), F.lit(False))
    marked = _with_threshold(df, limits, groups, "left").withColumn(mark, taken)
    return marked.select(*df.columns, mark)


def take_exact(
    df: DataFrame, quota: Quota, order_key: str = "order_key", groups: Sequence[str] = ()
) -> DataFrame:
    """Exactly k rows of each group, lowest keys first, and none more often than it came in.

    If a quota ends among rows of one key, these are ordered by a digest of the whole row
    and selected in the same way. Rows that still tie are copies of each other; they are
    counted and written out as often as needed, however many there are.
    """
    kept, tied = _split_at_limit(df, quota, order_key, groups)
    if tied is None:
        return kept
    digested = compute_once(tied, _digest=row_digest(tied.drop("_room")))

    def room_quota(counts: DataFrame) -> DataFrame:
        rooms = pin_small(tied.groupBy(*groups).agg(F.first("_room").alias("k")))
        if groups:
            return join_groups(counts, rooms, groups)
        return counts.withColumn("k", F.lit(rooms.first()["k"]))

    more, copies = _split_at_limit(digested.drop("_room"), room_quota, "_digest", groups)
    taken = kept.unionByName(more.drop("_digest"))
    if copies is None:
        return taken
    counted = copies.drop("_digest").groupBy(*df.columns).agg(F.first("_room").alias("_room"))
    return taken.unionByName(emit_copies(counted, "_room"))


def _split_at_limit(
    df: DataFrame, quota: Quota, order_key: str, groups: Sequence[str]
) -> tuple[DataFrame, DataFrame | None]:
    """The rows that are in for sure, and those of a key within which a quota ends.

    The latter have ``_room``, how many of them to take in their group; None if there are none.
    """
    limits = thresholds(df, quota, order_key, groups)
    compared = _with_threshold(df, limits, groups, "inner")
    room = F.col("_k") - F.col("_before")
    at_limit = F.col(order_key) == F.col("_last")
    whole = (F.col(order_key) < F.col("_last")) | (at_limit & (room == F.col("_tied")))
    kept = compared.where(whole).select(*df.columns)
    if limits.where(F.col("k") - F.col("before") < F.col("at_value")).isEmpty():
        return kept, None
    tied = compared.where(at_limit & (room < F.col("_tied")))
    return kept, tied.select(*df.columns, room.alias("_room"))


def take_shares(frames: Sequence[tuple[DataFrame, float]], order_key: str = "order_key") -> list[DataFrame]:
    """Of each frame the whole number of rows that does not exceed its share, lowest keys first.

    The frames may have any columns: only their keys are put into one table, with a group for
    each frame, so the number of jobs does not grow with the number of frames. Rows that tie at
    the last key are chosen as ``take_exact`` does, again for all frames at once.
    """
    if not frames:
        return []
    shares = dict(enumerate(share for _, share in frames))

    def share_quota(counts: DataFrame) -> DataFrame:
        wanted = F.create_map(*[F.lit(x) for at, share in shares.items() for x in (at, float(share))])
        share = wanted[F.col("_frame")]
        return counts.withColumn("k", F.floor(F.col("available").cast("double") * share).cast("bigint"))

    whole: list[DataFrame] = []
    open_frames: dict[int, tuple[DataFrame, int]] = {}
    for at, (kept, tied, room) in _at_limits(dict(enumerate(f for f, _ in frames)), share_quota, order_key).items():
        whole.append(kept)
        if tied is not None:
            open_frames[at] = (compute_once(tied, _digest=row_digest(tied)), room)
    if open_frames:
        rooms = {at: room for at, (_, room) in open_frames.items()}

        def room_quota(counts: DataFrame) -> DataFrame:
            room = F.create_map(*[F.lit(x) for pair in rooms.items() for x in pair])[F.col("_frame")]
            return counts.withColumn("k", room.cast("bigint"))

        chosen = _at_limits({at: df for at, (df, _) in open_frames.items()}, room_quota, "_digest")
        for at, (more, copies, room) in chosen.items():
            columns = frames[at][0].columns
            taken = whole[at].unionByName(more.select(*columns))
            if copies is not None:
                # Rows of one digest are copies of each other: as many as there is room for.
                counted = copies.select(*columns).groupBy(*columns).agg(F.lit(room).cast("bigint").alias("_room"))
                taken = taken.unionByName(emit_copies(counted, "_room"))
            whole[at] = taken
    return whole


def _at_limits(
    frames: dict[int, DataFrame], quota: Quota, order_key: str
) -> dict[int, tuple[DataFrame, DataFrame | None, int]]:
    """Per frame the rows that are in for sure, those of a key within which its quota ends, and the room for these."""
    keyed = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(at).alias("_frame"), F.col(order_key).alias("_key")) for at, df in frames.items()],
    )
    # One line per frame.
    limits = {line["_frame"]: line for line in thresholds(keyed, quota, "_key", ["_frame"]).collect()}
    found: dict[int, tuple[DataFrame, DataFrame | None, int]] = {}
    for at, df in frames.items():
        line = limits.get(at)
        if line is None:
            found[at] = df.where(F.lit(False)), None, 0
            continue
        key, room = F.col(order_key), line["k"] - line["before"]
        if room == line["at_value"]:
            found[at] = df.where(key <= line["value"]), None, 0
        else:
            found[at] = df.where(key < line["value"]), df.where(key == line["value"]), room
    return found


def first_rows(df: DataFrame, rows: int, order_key: str = "order_key") -> DataFrame:
    """The first ``rows`` rows in key order, by the same selection for every size."""
    return take_exact(df, fixed_quota(rows), order_key)


def exact_medians(
    df: DataFrame, value: str, groups: Sequence[str] = (), gathered_rows: int = GATHERED_ROWS
) -> DataFrame:
    """Exact median of a numeric column per group: ``groups, median``.

    The range that holds the middle is narrowed, one narrow pass at a time, until
    it holds few enough rows or a single value: first to values of one sign and power
    of two, then by 16 bits a pass, so five passes are enough for any numbers. Then its
    values are counted and ranked. Two middle values are averaged. NaN counts as larger than
    all numbers, as Spark orders it. The values are written once, so no pass
    computes the input again.
    """
    present = materialize(
        df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("v")),
        "median_values",
    )
    sizes = present.groupBy(*groups).agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("rows")
    )
    twice = F.array((F.col("rows") + 1).cast("bigint"), (F.col("rows") + 2).cast("bigint"))
    halves = F.array_distinct(F.transform(twice, lambda n: F.floor(n / 2)))
    # One line per wanted rank: the range it lies in, and its rank inside that range.
    lines = pin_small(sizes.select(*groups, "low", "high", "rows", F.explode(halves).alias("k")))
    open_range = (F.col("rows") > gathered_rows) & (F.col("low") < F.col("high"))

    def in_range(lines: DataFrame) -> DataFrame:
        ranges = lines.select(*groups, "low", "high").distinct()
        if groups:
            joined = present.join(ranges, list(groups))
        else:
            # At most two ranges, one for each middle rank.
            pairs = [
                F.struct(F.lit(line["low"]).alias("low"), F.lit(line["high"]).alias("high"))
                for line in ranges.collect()
            ] or [F.struct(F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))]
            joined = present.select("*", F.inline(F.array(*pairs)))
        return joined.where((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))

    power = F.floor(F.log2(F.abs("v"))) + 1_500
    by_power = (
        F.when(F.isnan("v"), 10_000)
        .when(F.col("v") == float("inf"), 9_000)
        .when(F.col("v") == float("-inf"), -9_000)
        .when(F.col("v") == 0, 0)
        .otherwise(F.when(F.col("v") > 0, power).otherwise(-power))
        .cast("bigint")
    )
    spread = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low"))
    by_place = F.floor(spread * (VALUE_BUCKETS - 1))
    first_pass = True
    while not lines.where(open_range).isEmpty():
        bucket = F.when(F.col("low") < F.col("high"), by_power if first_pass else by_place)
        first_pass = False
        keys = [*groups, "low", "high"]
        histogram = (
            in_range(lines)
            .groupBy(*keys, F.coalesce(bucket, F.lit(0)).alias("bucket"))
            .agg(F.min("v").alias("least"), F.max("v").alias("most"), F.count("*").alias("n"))
        )
        counted = _running(histogram, keys, "bucket").join(lines.drop("rows"), keys)
        inside = counted.where((F.col("before") < F.col("k")) & (F.col("k") <= F.col("upto")))
        lines = pin_small(
            inside.select(
                *groups,
                F.col("least").alias("low"),
                F.col("most").alias("high"),
                F.col("n").alias("rows"),
                (F.col("k") - F.col("before")).alias("k"),
            )
        )

    keys = [*groups, "low", "high"]
    tallies = in_range(lines).groupBy(*keys, "v").agg(F.count("*").alias("n"))
    ranked = _running(tallies, keys, "v").join(lines.drop("rows"), keys)
    middle = ranked.where((F.col("before") < F.col("k")) & (F.col("k") <= F.col("upto")))
    return middle.groupBy(*groups).agg(F.avg("v").alias("median"))
