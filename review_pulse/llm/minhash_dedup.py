"""Near-duplicate groups: MinHash, banding, signature and set verification, large-star/small-star.

1. Each text becomes the set of its word shingles (64-bit hashes), 120 minima of universal hashes,
   and 24 band keys of five minima each. Equal sets are one vertex, the smallest id among them.
2. In each bucket of the first bands every vertex is paired with the smallest one only. Pairs whose
   signatures agree enough are confirmed on the full sets; connected components follow.
3. Buckets of any band that still hold several components are compared once more, all members of
   different components, by their signatures; members that agree with one of another component meet
   again with their full sets, which give the links that join components. A bucket is cut into blocks
   of bounded size, and each task sees one block or two; members of one large component never meet.
   Only members and joining links are written, never all pairs. So no pair of texts that share a
   bucket stays untested unless it is connected already.

Links: ``100 * intersection >= 100 * threshold * union`` of the sets, counted exactly. Two texts at
the threshold of 0.8 miss all 24 buckets with a probability of 7e-5, more similar ones far less.

Defined results: a text without words (or NULL) has an empty set and is linked with nothing; a text
with fewer words than a shingle is one shingle; rows that share an id are one vertex, with the links
of all their texts; rows without an id are vertices of their own, kept, with a NULL component.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_pulse.llm import bytewise
from review_pulse.llm.shared import remove, stored

BANDS, ROWS = 24, 5
STAR_BANDS = 8  # bands whose buckets are first joined through their smallest member
MARGIN = 0.15  # four standard deviations of a signature's agreement at the threshold
COMPARED = 1 << 22  # signature values compared at once
BLOCK_BYTES = 1 << 24  # of a bucket's members that one task sees twice at most, in two blocks
MEMBER_BYTES = 1 << 12  # what a member counts for besides its set
MAX_BITS = 1 << 25  # of the ids that are picked by their hashes: 4 MB
BITS = 4  # of one id
SETS = 1000  # sets that a task puts together
_SEED = 20240101


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(_SEED)
    odd = draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1) | np.uint64(1)
    return odd, draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased."""
    data, starts = bytewise.utf8(column)
    factors = bytewise.mixed(np.arange(1, width + 1, dtype=np.uint64))
    for low, high in bytewise.groups(starts):
        some = bytewise.LOWER[data[starts[low] : starts[high]]]
        begin, end, first = bytewise.spans(some, starts[low : high + 1] - starts[low], ~bytewise.IS_SPACE)
        words = bytewise.hash_spans(some, begin, end)
        count = max(0, len(words) - width + 1)
        rolled = np.zeros(count, np.uint64)
        for k in range(width):
            rolled += bytewise.mixed(words[k : k + count] + factors[k])* factors[k]
        rolled = bytewise.mixed(rolled)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= width:
                yield np.unique(rolled[a : b - width + 1])
            elif b > a:  # the whole sequence, apart from all full shingles
                yield bytewise.mixed(np.array([hash_sequence(words[a:b], factors)], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def hash_sequence(words: np.ndarray, factors: np.ndarray) -> int:
    total = len(words)
    for word, factor in zip(words.tolist(), factors.tolist()):
        total = (total * 0x9E3779B97F4A7C15 + (word ^ factor)) % (1 << 64)
    return total


def signature(values: np.ndarray, odd: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash over the set, in 32 bits."""
    out = np.full(len(odd), np.uint32(0xFFFFFFFF))
    for low in range(0, len(values), 4096):
        hashed = odd[:, None] * values[None, low : low + 4096]
        hashed += shift[:, None]
        hashed >>= np.uint64(32)
        np.minimum(out, hashed.min(1).astype(np.uint32), out=out)
    return out


def digest_of(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def signed(documents: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature bytes and band keys of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd, shift = _multipliers()
        numbers = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            sizes, digests, signatures, bands = [], [], [], []
            for values in shingle_sets(batch.column(1), width):
                sizes.append(len(values))
                if not len(values):
                    digests.append(None), signatures.append(None), bands.append(None)
                    continue
                minima = signature(values, odd, shift)
                key = numbers.copy()
                for k in range(ROWS):
                    key = bytewise.mixed(key * np.uint64(0x9E3779B97F4A7C15) + minima[k::ROWS].astype(np.uint64))
                digests.append(digest_of(values))
                signatures.append(minima.tobytes())
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                pa.array(signatures, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
            ], ["id", "n", "digest", "signature", "bands"])

    return documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("t")).mapInArrow(
        run, "id long, n long, digest binary, signature binary, bands array<long>")


def may_be_in(ids: DataFrame) -> Callable[[Column], Column]:
    """A condition that holds for every one of some ids, and for few others: all bits of its hashes are set.

    There are a few times as many bits as ids, ``MAX_BITS`` at most. They are a literal of the plan, so rows are
    picked where they are and no text is shuffled to find out.
    """
    size = min(MAX_BITS, max(1 << 12, 1 << (16 * ids.count()).bit_length()))

    def places(own: Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(own, F.lit(k)), F.lit(size)) for k in range(BITS)])

    found = ids.select(F.explode(places(F.col("id"))).alias("place")).select(
        F.shiftright("place", 3).alias("byte"), F.expr("shiftleft(1, CAST(place % 8 AS INT))").alias("bit"))
    rows = found.groupBy("byte").agg(F.bit_or("bit").alias("mask")).toPandas()
    bits = np.zeros(size // 8, np.uint8)
    bits[rows["byte"].to_numpy()] = rows["mask"].to_numpy()
    table = F.unbase64(F.lit(base64.b64encode(bits.tobytes()).decode()))

    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(table, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

    return lambda own: F.forall(places(own), is_set)


def without(rows: DataFrame, number: str, dropped: DataFrame) -> DataFrame:
    """The rows whose number is not among the column ``id`` of ``dropped``.

    Rows that cannot be among them stay where they are. Of the others, only the numbers are joined; that
    gives the few that looked dropped and are not, and those alone are shuffled.
    """
    asked = may_be_in(dropped)(F.col(number))
    kept = stored(rows.where(asked).select(F.col(number).alias("id")).join(dropped, "id", "left_anti"), "dedup-kept")
    few = rows.where(asked & may_be_in(kept)(F.col(number))).join(kept.withColumnRenamed("id", number), number, "left_semi")
    return rows.where(~asked).unionByName(few.select(*rows.columns))


def full_sets(documents: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """id, digest and sorted set of the rows whose id is asked for, and of a few others, which meet
    nothing in the joins that follow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SETS):
                some = batch.slice(low, SETS)
                sets = [s.view(np.int64) for s in shingle_sets(some.column(1), width)]
                yield pa.RecordBatch.from_arrays([
                    some.column(0), pa.array([digest_of(s) for s in sets], pa.binary()),
                    pa.array(sets, pa.list_(pa.int64()))], ["id", "digest", "values"])

    own = F.col("doc_id").cast("long")
    rows = documents.where(may_be_in(ids)(own)).select(own.alias("id"), F.col("text").alias("t"))
    return rows.mapInArrow(run, "id long, digest binary, values array<long>")


def _agreeing(pairs: DataFrame, signatures: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures agree in at least the share ``least`` of their values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
                           for k in (2, 3))
            agree = (left == right).mean(1) >= least
            yield batch.select([0, 1]).filter(pa.array(agree))

    left = signatures.select(F.col("id").alias("a"), F.col("signature").alias("left"))
    right = signatures.select(F.col("id").alias("b"), F.col("signature").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _confirmed(documents: DataFrame, pairs: DataFrame, width: int, threshold: float) -> DataFrame:
    """Pairs (a, b) whose full sets are as similar as asked for, and their similarity."""
    asked = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "dedup-asked")
    sets = stored(full_sets(documents, asked, width), "dedup-sets")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("values").alias("left")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("values").alias("right")), "b")
    counted = both.select("a", "b", F.size(F.array_intersect("left", "right")).alias("common"),
                          (F.size("left") + F.size("right")).alias("sizes"))
    links = counted.where(F.col("common") * 100 >= F.lit(round(threshold * 100)) * (F.col("sizes") - F.col("common")))
    found = stored(links.select("a", "b").distinct(), "dedup-links")
    remove(sets)
    return found


def connected(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest vertex reachable, by alternating large-star and small-star.

    Each star is one grouping of the edges by vertex and one join back; edges are stored after each
    pair of stars, and it ends when the edges no longer change.
    """
    def stars(links: DataFrame, larger: bool) -> DataFrame:
        if larger:
            around = links.union(links.select(F.col("b"), F.col("a")))
        else:
            around = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        centre = around.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("m"))
        met = around.join(centre, "a")
        kept = met.where("b > a" if larger else "b <= a").select(F.col("b").alias("x"), "m")
        own = centre.select(F.col("a").alias("x"), "m")
        return (kept if larger else kept.union(own)).where("x <> m").distinct().select(
            F.col("x").alias("a"), F.col("m").alias("b"))

    def mark(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
    before = mark(edges)
    while True:
        following = stored(stars(stars(edges, True), False), "stars")
        remove(edges)
        edges, now = following, mark(following)
        if now == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = now


class Bucket:
    """The members of one block of a bucket, or of two, with their components and signatures.

    Each row meets the first ``until`` rows: of its own block those of components sorted before its
    own, of two blocks all those of the first.
    """

    def __init__(self, rows: pa.Table) -> None:
        self.table = rows.sort_by([(c, "ascending") for c in ("late", "component", "id", "digest")])
        self.ids, self.parts = (self.table.column(c).to_numpy().copy() for c in ("id", "component"))
        joined = b"".join(self.table.column("signature").to_pylist())
        self.signatures = np.frombuffer(joined, np.uint32).reshape(-1, BANDS * ROWS)
        late = self.table.column("late").to_numpy()
        if self.table.column("alike")[0].as_py():
            self.until = np.searchsorted(self.parts, self.parts)
        else:
            self.until = np.where(late, len(late) - late.sum(), 0)

    def agreeing(self, least: float) -> Iterator[tuple[int, np.ndarray]]:
        """Runs of rows, and which of the rows that each is to meet agree with it."""
        by_place = np.ascontiguousarray(self.signatures.T)
        step = max(1, COMPARED // max(1, self.signatures.size))
        for low in range(int(np.searchsorted(self.until, 1)), len(self.ids), step):
            until = self.until[low : low + step]
            agree = np.zeros((len(until), until[-1]), np.uint8)
            for mine, theirs in zip(by_place[:, low : low + step], by_place[:, : until[-1]]):
                agree += mine[:, None] == theirs
            yield low, (agree >= least * len(by_place)) & (np.arange(until[-1]) < until[:, None])


def _open_members(group: pa.Table, least: float) -> pa.Table:
    """The members of a bucket that agree with a member of another component."""
    bucket = Bucket(group)
    found = np.zeros(len(bucket.ids), bool)
    for low, agree in bucket.agreeing(least):
        found[low : low + len(agree)] |= agree.any(1)
        found[: agree.shape[1]] |= agree.any(0)
    return bucket.table.select(["id", "digest", "bucket", "band", "component"]).filter(pa.array(found))


def _bucket_links(group: pa.Table, least: float, threshold: float) -> pa.Table:
    """Links between components of a bucket, confirmed on the full sets, until no more can join two.

    A pair that shares the bucket of an earlier band is left to that bucket.
    """
    bucket = Bucket(group)
    lists = bucket.table.column("values").combine_chunks()
    starts, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)  # the order they are sorted in
    sizes = np.diff(starts)
    bands = np.array(bucket.table.column("bands").to_pylist(), np.int64)[:, : bucket.table.column("band")[0].as_py()]
    links: list[tuple[int, int]] = []
    for low, agree in bucket.agreeing(least):
        for x in range(low, low + len(agree)):
            others = np.flatnonzero(agree[x - low])
            others = others[bucket.parts[others] != bucket.parts[x]]
            others = others[~(bands[others] == bands[x]).any(1)]
            if not len(others):
                continue
            own = values[starts[x] : starts[x + 1]]
            theirs = np.concatenate([values[starts[y] : starts[y + 1]] for y in others])
            hits = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            common = np.add.reduceat(hits.astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
            for y in others[100 * common >= round(100 * threshold) * (sizes[x] + sizes[others] - common)]:
                if bucket.parts[y] != bucket.parts[x]:
                    links.append((int(bucket.ids[x]), int(bucket.ids[y])))
                    bucket.parts[bucket.parts == bucket.parts[y]] = bucket.parts[x]
    a, b = (pa.array([link[k] for link in links], pa.int64()) for k in (0, 1))
    return pa.table({"a": a, "b": b})


def in_blocks(members: DataFrame, block_bytes: int) -> DataFrame:
    """Members of buckets once for each pair of blocks that theirs is in: columns first and second,
    with ``late`` for members of the second and ``alike`` where both are one block.

    A component above the size of a block has blocks of its own, dealt by a hash of the member, which
    never meet each other; all others of a bucket share blocks by a hash of the component. So two
    blocks hold at most a few times ``block_bytes``, and members of one component are compared in none.
    """
    parts = members.groupBy("bucket", "component").agg(F.sum("bytes").alias("bytes"))
    alone = F.col("bytes") > block_bytes
    parts = parts.select(
        "bucket", "component", F.col("bytes").alias("all"), alone.alias("alone"),
        F.when(alone, F.lit(0)).otherwise(F.col("bytes")).alias("shared"))
    shared = parts.groupBy("bucket").agg(F.ceil(F.sum("shared") / block_bytes).alias("n"), F.count("*").alias("several"))
    sized = parts.join(shared.where("several > 1"), "bucket").select(
        "bucket", "component", "alone", F.when(F.col("alone"), F.ceil(F.col("all") / block_bytes)).otherwise(F.col("n")).alias("n"))
    owner = F.when(F.col("alone"), F.col("component")).otherwise(0)
    block = lambda salt: F.struct("alone", owner.alias("owner"), salt.alias("salt"))
    salt = F.pmod(F.when(F.col("alone"), F.xxhash64("id", "digest")).otherwise(F.xxhash64("component", "bucket")), F.col("n"))
    placed = members.join(sized, ["bucket", "component"]).withColumn("block", block(salt)).drop("alone", "n")
    blocks = sized.select("bucket", "alone", owner.alias("component"), "n").distinct().select(
        "bucket", "alone", "component", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("salt"))
    blocks = blocks.select("bucket", F.struct("alone", F.col("component").alias("owner"), "salt").alias("first"))
    apart = (F.col("first") <= F.col("second")) & ~(
        F.col("first.alone") & F.col("second.alone") & (F.col("first.owner") == F.col("second.owner")))
    met = blocks.join(blocks.withColumnRenamed("first", "second"), "bucket").where(apart)
    asked = met.select("bucket", "first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("block"))
    return placed.join(asked, ["bucket", "block"]).select(
        *members.columns, "first", "second", (F.col("block") == F.col("second")).alias("late"),
        (F.col("first") == F.col("second")).alias("alike"))


def _late_links(documents: DataFrame, members: DataFrame, components: DataFrame, vertices: DataFrame,
                width: int, threshold: float) -> DataFrame:
    """Confirmed links between members of one bucket that are in different components.

    Full sets are sent only for members that agree with one of another component.
    """
    least = threshold - MARGIN
    placed = _labelled(members, components)
    buckets = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    inside = stored(placed.join(buckets, "bucket").withColumn("bytes", F.lit(MEMBER_BYTES).cast("long")), "dedup-inside")
    each = in_blocks(inside, BLOCK_BYTES).join(vertices.select("id", "digest", "signature"), ["id", "digest"])
    agree = stored(each.groupBy("bucket", "first", "second").applyInArrow(
        lambda group: _open_members(group, least),
        "id long, digest binary, bucket long, band int, component long").distinct(), "dedup-open")
    remove(inside)
    asked = stored(agree.select("id", "digest").distinct(), "dedup-asked")
    sets = stored(full_sets(documents, asked.select("id").distinct(), width).dropDuplicates(["id", "digest"]).join(
        asked, ["id", "digest"], "left_semi"), "dedup-sets")
    whole = vertices.where(may_be_in(asked)(F.col("id"))).join(sets, ["id", "digest"])
    weights = sets.select("id", "digest", (F.size("values") * 8 + MEMBER_BYTES).cast("long").alias("bytes"))
    found = in_blocks(agree.join(weights, ["id", "digest"]), BLOCK_BYTES).join(whole, ["id", "digest"])
    links = stored(found.groupBy("bucket", "first", "second").applyInArrow(
        lambda group: _bucket_links(group, least, threshold), "a long, b long").distinct(), "dedup-links")
    remove(sets)
    return links


def _labelled(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Rows with the component of their id, which is the id itself where it has no links."""
    named = components.select("id", F.col("component").alias("linked"))
    return rows.join(named, "id", "left").withColumn("component", F.coalesce("linked", "id")).drop("linked")


def grouped(documents: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """(id, n, component) of every row of ``documents``, row by row."""
    rows = stored(signed(documents, width), "dedup-signed")
    least = threshold - MARGIN
    usable = rows.where("id is not null and n > 0")
    classes = stored(usable.groupBy("digest").agg(F.min("id").alias("low")), "dedup-classes")
    row_class = usable.select("id", "digest").join(classes, "digest").select("id", "low").distinct()
    several = row_class.groupBy("id").agg(F.min("low").alias("b"), F.max("low").alias("high")).where("b <> high")
    same_id = row_class.join(several, "id").select(F.col("low").alias("a"), "b")
    vertices = stored(usable.join(classes, (usable["id"] == classes["low"]) & (usable["digest"] == classes["digest"])).select(
        "id", usable["digest"], "signature", "bands").dropDuplicates(["id", "digest"]), "dedup-vertices")
    spread = vertices.select("id", "digest", F.posexplode("bands").alias("band", "bucket"))
    buckets = spread.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    members = stored(spread.join(buckets, "bucket").select("id", "digest", "band", "bucket", "low"), "dedup-members")
    signatures = vertices.select("id", "signature")
    stars = members.where((F.col("id") != F.col("low")) & (F.col("band") < STAR_BANDS)).select(
        F.col("id").alias("a"), F.col("low").alias("b")).distinct()
    pairs = stored(_agreeing(stars, signatures, least).distinct(), "dedup-pairs")
    first = connected(_confirmed(documents, pairs, width, threshold).union(same_id))
    late = _late_links(documents, members.select("id", "digest", "band", "bucket"), first, vertices, width, threshold)
    late = _labelled(late.withColumnRenamed("a", "id"), first).select(F.col("component").alias("a"), F.col("b").alias("id"))
    late = _labelled(late, first).select("a", F.col("component").alias("b"))
    second = connected(late)
    final = _labelled(_labelled(row_class.select(F.col("id").alias("row_id"), F.col("low").alias("id")), first).select(
        "row_id", F.col("component").alias("id")), second)
    final = final.groupBy(F.col("row_id").alias("id")).agg(F.min("component").alias("component"))
    return _labelled(rows.select("id", "n"), final)


def marked(documents: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id and ``kept`` of every row."""
    return grouped(documents, width, threshold).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def deduplicated(documents: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row of each group of near duplicates: of the smallest id, rows without an id last.

    Rows are told apart by a number of their own, so copies that repeat an id or have none count as
    copies, and rows of one id with unlike texts do not. Texts without words are all kept.
    """
    rows = stored(documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole_row"),
        F.monotonically_increasing_id().alias("number")), "dedup-rows")
    groups = grouped(rows.select(F.col("number").alias("doc_id"), F.col("whole_row.text").alias("text")), width, threshold)
    named = groups.join(rows.select(F.col("number").alias("id"), F.col("whole_row.doc_id").alias("doc_id")), "id")
    named = stored(named.select("id", "component", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "id").alias("place")), "dedup-named")
    best = named.groupBy("component").agg(F.min("place").alias("best")).select(F.col("best.id").alias("id"))
    return without(rows, "number", stored(named.select("id").join(best, "id", "left_anti"), "dedup-dropped")).select("whole_row.*")
