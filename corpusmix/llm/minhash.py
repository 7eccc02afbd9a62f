"""Near duplicates by fast similarity sketching, banding and exact comparison.

A sketch has ``COORDINATES`` bins. In each round every shingle of a set is hashed into one
bin with a value, and values of earlier rounds are smaller than those of later ones; rounds go on
while a bin is empty, and from round ``COORDINATES`` on a round puts all shingles into one
given bin, so that every bin fills. Sets of usual size are done after a few rounds,
so a sketch costs little more than one hash per shingle, and each coordinate agrees with
the probability of the sets' similarity.

Bands of coordinates give buckets of candidates. Documents with equal sets are one class and
one candidate. Within a bucket all classes are first compared with one of them; then
components are formed, and only buckets that still hold several are looked at again:
each class outside the bucket's largest component is compared with one more class of that.
What is still apart is compared with all classes of other components in buckets that are small or
have few classes apart. In others a bound leaves out pairs that cannot be linked: every set is written as its difference
from a centre, the shingles that most of a few members have. Two sets of ``a`` and ``b`` shingles
that differ from the centre in ``d`` and ``e`` are linked if, and only if, their differences share
at least ``(d + e - (a + b) * (100 - P) / (100 + P)) / 2`` shingles, so with the shingles of all
differences in one order, the first ones of both must meet. In that order those come first that are in fewest
differences of the centre, so edits that many copies share come last and few sets meet. A centre that fits badly
costs time and no link. All comparisons are of the full sets, so no link between candidates is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmix.llm.common import map_batches
from corpusmix.llm.components import components
from corpusmix.session import materialize

COORDINATES = 128
BAND_SIZE = 4
SHINGLE_WORDS = 5
MIN_PERCENT = 80
VALUE_BITS = 48
SMALL_BUCKET = 16  # classes; and
FEW_APART = 4  # classes outside the largest component: in buckets above both, pairs go through the bound first
CENTRE_MEMBERS = 16  # members that a centre is made from; it only decides how well the bound works
KEY_SCHEMA = "doc_id bigint, text_key string, n_shingles long, set_key binary, bands array<bigint>"
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text.

    A-Z are lower-cased; a text with fewer words has one shingle, all of them; one
    without any has none.
    """
    parts = (text or "").encode("utf-8").lower().split()
    if not parts:
        return np.zeros(0, _U)
    hashed = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts)), dtype="<u8")
    if len(hashed) < words:
        whole = xxhash.xxh64_intdigest(hashed.tobytes(), seed=len(hashed))
        return np.array([whole], _U)
    size = len(hashed) - words + 1
    shingles = hashed[:size]
    for k in range(1, words):
        shingles = _mixed(shingles) + hashed[k : k + size]
    return np.unique(_mixed(shingles))


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One row of ``coordinates`` values per set; a row of an empty set is all ones."""
    unfilled = np.iinfo(np.uint64).max
    table = np.full((len(sets), coordinates), unfilled, dtype=_U)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    shingles = np.concatenate(sets) if len(sets) else np.zeros(0, _U)
    flat = table.reshape(-1)
    for turn in range(2 * coordinates):
        if not len(shingles):
            break
        seed = int(_mixed(np.array([turn + 1], _U))[0])
        x = _mixed(shingles ^ _U(seed))
        value = (x & _U((1 << VALUE_BITS) - 1)) | _U(turn << VALUE_BITS)
        if turn < coordinates:
            bins = ((x >> _U(VALUE_BITS)) % _U(coordinates)).astype(np.int64)
        else:
            bins = turn - coordinates
        np.minimum.at(flat, owner * coordinates + bins, value)
        goes_on = (table == unfilled).any(axis=1)[owner]
        if not goes_on.all():
            shingles, owner = shingles[goes_on], owner[goes_on]
    return table


def band_hashes(table: np.ndarray, band_size: int = BAND_SIZE) -> np.ndarray:
    """One 64-bit bucket per band of each sketch; bands do not share buckets."""
    rows, coordinates = table.shape
    bands = table.reshape(rows, coordinates // band_size, band_size)
    out = np.broadcast_to(np.arange(coordinates // band_size, dtype=_U) + _U(1), bands.shape[:2])
    for k in range(band_size):
        out = _mixed(out ^ bands[:, :, k]) + _U(k)
    return out.astype(np.int64)


def _keys(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(text.as_py(), words) for text in part.column(1)]
                bands = band_hashes(sketches(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([b if len(s) else None for s, b in zip(sets, bands)], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_key", "n_shingles", "set_key", "bands"],
                )

    return run


def _confirm(words: int, min_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}  # pivots come again and again

        def side(doc_id: int, text: str) -> np.ndarray:
            if doc_id not in known:
                if len(known) >= 256:
                    known.clear()
                known[doc_id] = shingle_set(text, words)
            return known[doc_id]

        for batch in batches:
            a, b, text_a, text_b = batch.columns
            linked = []
            for k in range(batch.num_rows):
                one = side(b[k].as_py(), text_b[k].as_py())
                other = shingle_set(text_a[k].as_py(), words)
                shared = len(np.intersect1d(one, other, assume_unique=True))
                linked.append(100 * shared >= min_percent * (len(one) + len(other) - shared))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def _confirmed(
    pairs: DataFrame, texts: DataFrame, words: int, min_percent: int
) -> DataFrame:
    """``a, b, linked`` for pairs of class ids, by their full sets."""
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return materialize(
        map_batches(joined, _confirm(words, min_percent), "a bigint, b bigint, linked boolean"),
        "compared_pairs",
    )


def _fit(min_percent: int):
    """True if the sizes alone do not rule out a link."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return 100 * small >= min_percent * large


def _members(words: int):
    """Shingles of each ``centre, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(text.as_py(), words).astype(np.int64) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["centre", "shingles"]
                )

    return run


def difference(shingles: np.ndarray, known: np.ndarray, counts: np.ndarray, members: int) -> np.ndarray:
    """Shingles in which a set differs from the centre, rare differences first.

    ``known`` are the shingles that any of ``members`` sets had, and ``counts`` how many had
    each; the centre has those that more than half had.
    """
    central = 2 * counts > members
    parts = np.setxor1d(shingles, known[central], assume_unique=True)
    order = np.argsort(known)
    at = order[np.minimum(np.searchsorted(known, parts, sorter=order), max(len(known) - 1, 0))] if len(known) else None
    rarity = np.zeros(len(parts), np.int64)
    if at is not None:
        met = known[at] == parts
        rarity[met] = np.minimum(counts[at], members - counts[at])[met]
    return parts[np.lexsort((parts, rarity))]


def _differences(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centre, class_id, n, root, outside, text, members, known, counts = batch.columns
            sizes, all_parts = [], []
            for k in range(batch.num_rows):
                parts = difference(
                    shingle_set(text[k].as_py(), words).astype(np.int64),
                    known[k].values.to_numpy(),
                    counts[k].values.to_numpy(),
                    members[k].as_py(),
                )
                sizes.append(len(parts))
                all_parts.append(parts)
            yield pa.RecordBatch.from_arrays(
                [centre, class_id, n, root, outside, pa.array(sizes, pa.int64()), pa.array(all_parts, pa.list_(pa.int64()))],
                ["centre", "class_id", "n", "root", "outside", "d", "parts"],
            )

    return run


def _bounded_pairs(placed: DataFrame, texts: DataFrame, words: int, min_percent: int) -> DataFrame:
    """``a, b, n_a, n_b`` that may be linked, of ``placed`` (``centre, class_id, n, root, outside``).

    Has all linked pairs of one centre with different roots, one of them outside, or
    links each of both with the set that is nearest to the centre.
    """
    text_of = texts.select(F.col("doc_id").alias("class_id"), "text")
    turn = F.row_number().over(Window.partitionBy("centre").orderBy(F.xxhash64("class_id"), "class_id"))
    chosen = placed.select("centre", "class_id").withColumn("_turn", turn).where(F.col("_turn") <= CENTRE_MEMBERS)
    sets = map_batches(
        chosen.join(text_of, "class_id").select("centre", "text"), _members(words), "centre bigint, shingles array<bigint>"
    )
    sizes = placed.groupBy("centre").agg(F.least(F.count("*"), F.lit(CENTRE_MEMBERS)).alias("members"))
    centres = materialize(
        sets.select("centre", F.explode("shingles").alias("shingle"))
        .groupBy("centre", "shingle")
        .agg(F.count("*").cast("bigint").alias("count"))
        .join(sizes, "centre")
        .where((F.col("count") > 1) | (2 * F.col("count") > F.col("members")))
        .groupBy("centre", "members")
        .agg(F.collect_list(F.struct("shingle", "count")).alias("known")),
        "centres",
    )
    about = sizes.join(centres.drop("members"), "centre", "left").select(
        "centre",
        "members",
        F.coalesce("known.shingle", F.array().cast("array<bigint>")).alias("known"),
        F.coalesce("known.count", F.array().cast("array<bigint>")).alias("counts"),
    )
    joined = placed.join(text_of, "class_id").join(about, "centre")
    different = materialize(
        map_batches(
            joined.select("centre", "class_id", "n", "root", "outside", "text", "members", "known", "counts"),
            _differences(words),
            "centre bigint, class_id bigint, n long, root bigint, outside boolean, d long, parts array<bigint>",
        ),
        "differences",
    )
    more, less = 100 + min_percent, 100 - min_percent
    spread = (more * F.col("d") - less * F.col("n")).alias("s")  # two sets are surely linked if their sum is 0 or less
    nearest = different.groupBy("centre").agg(F.min(F.struct(spread, "class_id", "n", "root")).alias("near"))
    sure = (
        different.select("centre", F.col("class_id").alias("a"), F.col("n").alias("n_a"), "root", spread)
        .join(nearest, "centre")
        .where((F.col("s") + F.col("near.s") <= 0) & (F.col("root") != F.col("near.root")))
        .select("a", F.col("near.class_id").alias("b"), "n_a", F.col("near.n").alias("n_b"))
    )
    # Parts that no other difference has come first and meet nothing; then the rest by how many have them.
    listed = different.select("centre", "class_id", F.explode("parts").alias("shingle"))
    times = listed.groupBy("centre", "shingle").agg(F.count("*").alias("times")).where(F.col("times") > 1)
    met = (
        listed.join(times, ["centre", "shingle"])
        .groupBy("centre", "class_id")
        .agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("met"))
    )
    placed_parts = different.drop("parts").join(met, ["centre", "class_id"])
    first = placed_parts.select(
        "centre", "class_id", "n", "root", "outside", "d", spread, F.size("met").alias("of"), F.posexplode("met.shingle").alias("pos", "shingle")
    ).withColumn("at", F.col("d") - F.col("of") + F.col("pos"))
    # A linked set has at most n * 100 / P shingles, so no pair needs more than these.
    first = materialize(first.where(F.col("at") <= F.expr(f"n * {less} div {min_percent}")), "first_parts")
    one, other = (
        first.select("centre", "shingle", *(F.col(c).alias(f"{c}_{x}") for c in ("class_id", "n", "root", "outside", "d", "s", "at")))
        for x in "ab"
    )
    needed = F.ceil((F.col("s_a") + F.col("s_b")) / (2 * more))
    may = (
        (F.col("root_a") != F.col("root_b"))
        & (~F.col("outside_b") | (F.col("class_id_a") < F.col("class_id_b")))
        & (needed > 0)  # the others are in one component with the nearest set
        & (F.col("d_a") - F.col("at_a") >= needed)
        & (F.col("d_b") - F.col("at_b") >= needed)
    )
    met = one.where("outside_a").join(other, ["centre", "shingle"]).where(may)
    return sure.unionByName(
        met.select(F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b"), "n_a", "n_b")
    )


def _classes(keys: DataFrame) -> DataFrame:
    """One line per different set: ``set_key, class_id, n, bands`` and a row that has it."""
    who = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    grouped = keys.groupBy("set_key").agg(
        F.min(who).alias("who"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    return materialize(grouped.withColumn("class_id", F.monotonically_increasing_id()), "shingle_classes")


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id, text, text_key``; the key is a digest of the whole text."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"))


def _roots_of_rows(plain: DataFrame, keys: DataFrame, words: int, min_percent: int, by_id: bool) -> DataFrame:
    """``doc_id, text_key, root`` of each row of ``keys``: rows of linked sets have one root.

    With ``by_id`` rows of one doc_id have one root as well.
    """
    classes = _classes(keys)
    numbered = materialize(
        keys.select("doc_id", "text_key", "set_key").join(classes.select("set_key", "class_id"), "set_key").drop("set_key"),
        "rows_of_classes",
    )
    bucketed = classes.select(F.explode("bands").alias("bucket"), "class_id", "n")
    order = F.struct(F.xxhash64("class_id"), F.col("class_id").alias("id"), F.col("n").alias("n"))
    shared = (
        bucketed.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min(order).alias("pivot"))
        .where(F.col("size") > 1)
        .select("bucket", F.col("pivot.id").alias("b"), F.col("pivot.n").alias("n_b"))
    )
    shared = materialize(shared, "buckets")
    rows = materialize(bucketed.join(shared.select("bucket"), "bucket", "left_semi"), "bucket_rows")
    needed = rows.select("class_id").distinct()
    shown = classes.join(needed, "class_id", "left_semi").select(
        F.col("class_id").alias("_class"), F.col("who.doc_id").alias("_id"), F.col("who.text_key").alias("_key")
    )
    is_shown = (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    found = plain.join(shown, is_shown).select(F.col("_class").alias("doc_id"), "text")
    texts = materialize(found.dropDuplicates(["doc_id"]), "candidate_texts")
    compared = plain.sparkSession.createDataFrame([], "a bigint, b bigint, linked boolean")
    roots = plain.sparkSession.createDataFrame([], "node bigint, root bigint")
    if by_id:
        several = numbered.groupBy("doc_id").agg(F.min("class_id").alias("b"), F.max("class_id").alias("_most"))
        several = materialize(several.where(F.col("b") != F.col("_most")).drop("_most"), "ids_of_several")
        if not several.isEmpty():
            roots = components(numbered.join(several, "doc_id").select(F.col("class_id").alias("a"), "b"))

    def rooted(frame: DataFrame, node: str, root: str) -> DataFrame:
        named = roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
        return frame.join(named, node, "left").withColumn(root, F.coalesce("_root", node)).drop("_root")

    def settle(pairs: DataFrame) -> None:
        """Compare the pairs that have not been yet, and join the components they link."""
        nonlocal compared, roots
        new = pairs.where((F.col("a") != F.col("b")) & _fit(min_percent)).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        )
        fresh = new.distinct().join(compared.select("a", "b"), ["a", "b"], "left_anti")
        now = _confirmed(fresh, texts, words, min_percent)
        compared = compared.unionByName(now)
        links = now.where("linked").select("a", "b")
        if not links.isEmpty():
            before = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = components(before.unionByName(links))

    def open_buckets() -> DataFrame:
        """Rows of buckets that hold several components, with the component that has most of them."""
        placed = rooted(rows, "class_id", "root")
        mixed = (
            placed.groupBy("bucket")
            .agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
            .where(F.col("_low") != F.col("_high"))
            .select("bucket")
        )
        open_rows = materialize(placed.join(mixed, "bucket", "left_semi"), "open_rows")
        sizes = open_rows.groupBy("bucket", "root").agg(F.count("*").alias("size"))
        main = sizes.groupBy("bucket").agg(
            F.max(F.struct("size", "root")).alias("_most"), F.sum("size").alias("_all")
        )
        few = (F.col("_all") <= SMALL_BUCKET) | (F.col("_all") - F.col("_most.size") <= FEW_APART)
        return open_rows.join(main.select("bucket", F.col("_most.root").alias("main"), few.alias("few")), "bucket")

    def outside(marked: DataFrame) -> DataFrame:
        return marked.where(F.col("root") != F.col("main")).select(
            "bucket", F.col("class_id").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a")
        )

    # First every class with one of its bucket, the same in most buckets of a group.
    settle(rows.select("bucket", F.col("class_id").alias("a"), F.col("n").alias("n_a")).join(shared, "bucket"))
    # Then what is left with another class of the largest component, a different one in each bucket.
    marked = open_buckets()
    salted = F.struct(F.xxhash64("class_id", "bucket"), F.col("class_id").alias("id"), F.col("n").alias("n"))
    pivots = marked.where(F.col("root") == F.col("main")).groupBy("bucket").agg(F.min(salted).alias("pivot"))
    settle(
        outside(marked).join(
            pivots.select("bucket", F.col("pivot.id").alias("b"), F.col("pivot.n").alias("n_b")), "bucket"
        )
    )
    # At last what is still apart with everything in its buckets that is in another component.
    marked = open_buckets().join(
        shared.select("bucket", F.col("b").alias("centre")), "bucket"
    ).withColumn("outside", F.col("root") != F.col("main"))
    marked = materialize(marked, "last_rows")
    small = marked.where("few")
    one, other = (
        small.select("bucket", *(F.col(c).alias(f"{c}_{x}") for c in ("class_id", "n", "root", "outside"))) for x in "ab"
    )
    apart = (F.col("root_a") != F.col("root_b")) & (
        ~F.col("outside_b") | (F.col("class_id_a") < F.col("class_id_b"))
    )
    near = one.where("outside_a").join(other, "bucket").where(apart).select(
        F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b"), "n_a", "n_b"
    )
    placed = (
        marked.where(~F.col("few"))
        .groupBy("centre", "class_id")
        .agg(F.first("n").alias("n"), F.first("root").alias("root"), F.max("outside").alias("outside"))
    )
    placed = materialize(placed, "placed")
    settle(near.unionByName(_bounded_pairs(placed, texts, words, min_percent)))
    return rooted(numbered, "class_id", "root").select("doc_id", "text_key", "root")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, min_percent: int = MIN_PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs`` (``doc_id, text``).

    Two documents are linked if their sets share ``min_percent`` of their union or more;
    ``component_id`` is the least doc_id that can be reached. A null or empty text has no
    shingles and is linked with nothing. Rows of one doc_id are one node. A null doc_id
    is linked with nothing and kept. An empty table gives an empty one.

    With bands of 4 out of 128 coordinates, a pair of 80 % is missed as a candidate once in
    20 million pairs, a closer one less often.
    """
    plain = _rows(docs)
    keys = materialize(map_batches(plain, _keys(words), KEY_SCHEMA), "shingle_keys")
    usable = keys.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    placed = materialize(_roots_of_rows(plain, usable, words, min_percent, by_id=True), "roots_of_rows")
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_id = placed.select("doc_id", "root").distinct().join(least, "root").drop("root")
    found = keys.select("doc_id", "n_shingles").join(of_id, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", kept)


def drop_near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, min_percent: int = MIN_PERCENT
) -> DataFrame:
    """``docs`` with one row of each group of linked rows: that of the least doc_id, then of the least digest of its text.

    Here every row is judged by its own text, so no text goes without a linked one that stays, whatever the
    doc_ids: rows of one doc_id with different texts are not linked by it, a null doc_id comes after all
    others, and of rows with the same doc_id and text one stays, the least in all columns. Rows without
    words all stay. Columns of any names are kept.
    """
    plain = _rows(docs)
    keys = materialize(map_batches(plain, _keys(words), KEY_SCHEMA), "shingle_keys")
    usable = keys.where(F.col("set_key").isNotNull())
    placed = materialize(_roots_of_rows(plain, usable, words, min_percent, by_id=False), "roots_of_rows")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    # Copies of a row meet before the shuffle, so a group of many is one line per task.
    different = placed.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("times"))
    first = different.groupBy("root").agg(F.min(order).alias("first"))
    judged = materialize(
        different.join(first, "root").select("doc_id", "text_key", "times", (order != F.col("first")).alias("goes")), "judged_rows"
    )
    names = {"doc_id": "_id", "text_key": "_key"}
    while set(names.values()) & set(docs.columns):
        names = {old: f"_{new}" for old, new in names.items()}
    of_id, of_key = names["doc_id"], names["text_key"]
    own = F.md5(F.coalesce(F.col("text"), F.lit("")))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(of_id)) & (own == F.col(of_key))

    def lines(which: DataFrame) -> DataFrame:
        return which.select(*[F.col(old).alias(new) for old, new in names.items()])

    kept = docs.join(lines(judged.where("goes")), same, "left_anti")
    several = judged.where(~F.col("goes") & (F.col("times") > 1))
    if several.isEmpty():
        return kept
    kept = materialize(kept, "kept_rows")
    again = kept.join(lines(several), same, "left_semi")
    one = again.groupBy(F.col("doc_id").alias(of_id), own.alias(of_key)).agg(F.min(F.struct(*kept.columns)).alias("row"))
    return kept.join(lines(several), same, "left_anti").unionByName(one.select("row.*"))
