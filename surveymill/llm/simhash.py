"""Near-duplicates by SimHash: fingerprints joined by walking a binary trie against itself.

A fingerprint is a path of 64 bits in a binary trie. The join walks pairs of nodes of the same depth
together: a pair starts as a node with itself, each step goes down one bit to the pairs of children,
a pair that differs in the bit has one more error, and a pair over the error budget is dropped with
everything below it.

To deal the walk out, the 64 bits are cut into ``max_bits + 1`` blocks. Two fingerprints within the
budget agree in one whole block at least, so there is one trie for each block with that block rotated
to the top: the walk takes no error there, and every value of the block is a subtree of its own. Each is a unit
of work. A unit with more than ``node_limit`` fingerprints is cut into the pairs of its child nodes that the
budget still lets through, below the bits that all its fingerprints share; units are counted again after
each cut, until none is over the limit. A pair of which one node is empty is none. Each unit is a sorted array, a
node a range of it.

Links found in a unit leave it as a spanning forest, never as all pairs. Components of the links come
from large-star and small-star rounds on written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from surveymill.llm.common import arrow_schema, per_text, stage

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
_MOST_DEEPER = 12  # bits that a unit is cut by at a time
NODE_LIMIT = 50_000  # fingerprints of a unit that one walk takes
CHUNK = 200_000  # fingerprints of whole units that are walked at a time
FRONTIER = 250_000  # node pairs that are widened at a time
LINKS_OF_A_TASK = 100_000  # links of one node that one task joins
LINKS = "fp_a long, id_a long, fp_b long, id_b long"
_NO_ID = 2**63 - 1


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a text, repeats included: bit i is set if over half the hashes set it.

    A text of fewer words than a shingle is one shingle; a text without words has fingerprint zero.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words)]
    if len(words) > shingle_words:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    count = max(1, len(words) - shingle_words + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), "<u8", count)
    totals = np.zeros(64, np.int64)
    for start in range(0, count, 65536):
        bits = np.unpackbits(hashes[start : start + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * totals > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS):
    """``(id, fp)``: the fingerprint of every row as a signed long (null text: empty text)."""

    def work(texts):
        return {"fp": np.array([fingerprint(t, shingle_words) for t in texts], np.uint64).view(np.int64)}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return per_text(rows, ["id"], "text", work, "fp long")


# --- the walk ----------------------------------------------------------------------------------


def _widen(fps: np.ndarray, pairs: np.ndarray, bit: int, budget: int) -> np.ndarray:
    """The child pairs of node pairs. pairs: rows (a_lo, a_hi, b_lo, b_hi, errors), a node is a range of fps."""
    a_lo, a_hi, b_lo, b_hi, err = pairs
    ones = np.concatenate([[0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
    a_mid = a_hi - (ones[a_hi] - ones[a_lo])  # a node's range is sorted: those with a 0 bit come first
    b_mid = b_hi - (ones[b_hi] - ones[b_lo])
    same = (a_lo == b_lo) & (a_hi == b_hi)
    children = [
        np.stack([a_lo, a_mid, b_lo, b_mid, err]),
        np.stack([a_mid, a_hi, b_mid, b_hi, err]),
        np.stack([a_lo, a_mid, b_mid, b_hi, err + 1]),
        np.stack([a_mid, a_hi, b_lo, b_mid, err + 1])[:, ~same],
    ]
    made = np.concatenate(children, axis=1)
    a_size, b_size = made[1] - made[0], made[3] - made[2]
    alone = (made[0] == made[2]) & (a_size == 1) & (b_size == 1)  # a fingerprint with itself
    return made[:, (a_size > 0) & (b_size > 0) & (made[4] <= budget) & ~alone]


def walk(fps: np.ndarray, starts: np.ndarray, bits: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the budget. starts: node pairs whose nodes share the bits above ``bits``.

    Breadth first, but a frontier over FRONTIER pairs is worked off in parts, so memory stays bounded.
    """
    work = [(starts, bits)]
    while work:
        pairs, bit = work.pop()
        while pairs.shape[1]:
            single = (pairs[1] - pairs[0] == 1) & (pairs[3] - pairs[2] == 1)
            if single.any() or bit == 0:
                a, b = pairs[0][single], pairs[2][single]
                near = np.bitwise_count(fps[a] ^ fps[b]) <= budget
                yield a[near & (a != b)], b[near & (a != b)]
                pairs = pairs[:, ~single]
                if bit == 0 or not pairs.shape[1]:
                    break
            if pairs.shape[1] > FRONTIER:
                work += [(part, bit) for part in np.array_split(pairs, 2 + pairs.shape[1] // FRONTIER, axis=1)]
                break
            bit -= 1
            pairs = _widen(fps, pairs, bit, budget)


def _roots(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index of every index's component (links are taken in parts, none are kept)."""
    root = np.arange(n)
    for a, b in links:
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            low, high = np.minimum(ra, rb)[apart], np.maximum(ra, rb)[apart]
            np.minimum.at(root, high, low)
            while True:  # every index points to a root again
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _starts(unit: list[np.ndarray], node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The node pair each unit asks for, as rows (a_lo, a_hi, b_lo, b_hi, errors), and its split.

    unit: columns tree, top, a, b, split of rows sorted by unit, then node. A unit is the pair of its
    nodes a and b; with one node, the node with itself if a = b (else its mate has no fingerprints).
    """
    new_unit = np.concatenate([[True], np.any([u[1:] != u[:-1] for u in unit], axis=0)])
    lo = np.flatnonzero(new_unit | np.concatenate([[True], node[1:] != node[:-1]]))
    hi = np.append(lo[1:], len(node))
    opens = new_unit[lo]
    paired = np.append(~opens[1:], False)
    _, _, a, b, split = (u[lo] for u in unit)
    pick = np.flatnonzero(opens & (paired | (a == b)))
    mate = np.where(paired[pick], pick + 1, pick)
    errors = np.bitwise_count((a ^ b)[pick].astype(np.uint64)).astype(np.int64)
    return np.stack([lo[pick], hi[pick], lo[mate], hi[mate], errors]), split[pick]


def _spanning_links(columns: list[np.ndarray], depth: int, budget: int, schema: pa.Schema) -> pa.RecordBatch:
    """Walks the units in columns (tree, top, a, b, split, node, rot, id): each fingerprint with the
    first one, in order, of those it is linked to within these units."""
    order = np.lexsort((columns[6].view(np.uint64), columns[5], *columns[4::-1]))
    *unit, node, rot, ids = (c[order] for c in columns)
    fps = rot.view(np.uint64)
    starts, splits = _starts(unit, node)
    links = (
        pair
        for split in np.unique(splits)
        for pair in walk(fps, starts[:, splits == split], 64 - depth - int(split), budget)
    )
    root = _roots(len(fps), links)
    child = np.flatnonzero(root != np.arange(len(root)))
    turn = (unit[0] * depth).astype(np.uint64)
    back = np.where(turn == 0, fps, (fps >> turn) | (fps << ((np.uint64(64) - turn) % np.uint64(64)))).view(np.int64)
    ends = (back[child], ids[child], back[root[child]], ids[root[child]])
    return pa.RecordBatch.from_arrays([pa.array(x) for x in ends], schema=schema)


def _walk_units(batches: Iterator[pa.RecordBatch], depth: int, budget: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Spanning links of a partition sorted by unit; whole units of about CHUNK rows are walked at a time."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append([column.to_numpy(zero_copy_only=False) for column in batch.columns])
        size += batch.num_rows
        if size < CHUNK:
            continue
        columns = [np.concatenate(parts) for parts in zip(*held, strict=True)]
        before_last = np.flatnonzero(np.any([c != c[-1] for c in columns[:5]], axis=0))
        cut = int(before_last[-1]) + 1 if len(before_last) else 0
        if cut:
            yield _spanning_links([c[:cut] for c in columns], depth, budget, schema)
        held, size = [[c[cut:] for c in columns]], len(columns[0]) - cut
    if size:
        yield _spanning_links([np.concatenate(parts) for parts in zip(*held, strict=True)], depth, budget, schema)


def trie_units(classes: DataFrame, max_bits: int = MAX_BITS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """The distinct fingerprints ``(fp, id)`` in the units that one walk takes each: rows (tree, top, a, b, split, node, rot,
    id), where a unit (tree, top, a, b, split) is the pair of the nodes a and b, and ``node`` the one that a fingerprint
    is in. A unit over the limit is one that has no bits left to be cut by."""
    blocks = max_bits + 1
    depth = 64 // blocks
    turned = F.array(*[
        F.struct(
            F.lit(t).cast("long").alias("tree"),
            (F.expr(f"shiftleft(fp, {t * depth}) | shiftrightunsigned(fp, {64 - t * depth})") if t else F.col("fp")).alias("rot"),
        )
        for t in range(blocks)
    ])
    rows = classes.select("id", F.explode(turned).alias("t")).select(
        "id", "t.tree", "t.rot", F.expr(f"shiftrightunsigned(t.rot, {64 - depth})").alias("top")
    )
    none = F.lit(0).cast("long")
    units = rows.select("tree", "top", none.alias("a"), none.alias("b"), none.alias("split"), none.alias("node"), "rot", "id")
    parts = []
    while True:
        large = stage(_large_units(units, depth, node_limit), "simhash-large")
        hot = large.count()
        if not hot:
            parts.append(units)
            break
        known = F.broadcast(large) if hot <= 100_000 else large
        parts.append(units.join(known.select(*_UNIT), _UNIT, "left_anti"))
        units = stage(_cut_units(units.join(known, _UNIT), depth, max_bits), "simhash-units")
    return reduce(DataFrame.unionAll, parts)


def trie_links(classes: DataFrame, max_bits: int = MAX_BITS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links ``(fp_a, id_a, fp_b, id_b)`` that join distinct fingerprints ``(fp, id)`` within ``max_bits``.

    They span the same components as all pairs within the budget, and every one is implied by such pairs.
    """
    depth, schema = 64 // (max_bits + 1), arrow_schema(LINKS)
    dealt = trie_units(classes, max_bits, node_limit).repartition(*_UNIT).sortWithinPartitions(*_UNIT)
    return dealt.mapInArrow(lambda batches: _walk_units(batches, depth, max_bits, schema), LINKS)


_UNIT = ["tree", "top", "a", "b", "split"]


def _large_units(units: DataFrame, depth: int, node_limit: int) -> DataFrame:
    """The units over the limit that have bits left, with the bits ``skip`` that all of a unit's rows share below its
    split (0 for a pair of nodes) and the bits ``deeper`` to cut by: an even spread leaves half the limit."""
    rest = F.expr(f"IF(split >= {64 - depth}, 0L, shiftrightunsigned(shiftleft(rot, CAST({depth} + split AS INT)), CAST({depth} + split AS INT)))")
    counted = units.groupBy(*_UNIT).agg(F.count("*").alias("n"), F.min(rest).alias("least"), F.max(rest).alias("most"))
    left = F.lit(64 - depth) - F.col("split")
    differing = F.when(F.col("least") == F.col("most"), 0).otherwise(F.length(F.bin(F.col("least").bitwiseXOR(F.col("most")))))
    skip = F.when(F.col("a") == F.col("b"), left - differing).otherwise(0)
    large = counted.filter((F.col("n") > node_limit) & (left > 0)).withColumn("skip", skip.cast("long"))
    deeper = F.least(F.greatest(F.lit(1), F.ceil(F.log2(F.col("n") / node_limit)) + 1), left - F.col("skip"), F.lit(_MOST_DEEPER))
    return large.withColumn("deeper", deeper.cast("long")).filter("deeper > 0").select(*_UNIT, "skip", "deeper")


def _cut_units(units: DataFrame, depth: int, max_bits: int) -> DataFrame:
    """The rows of units with their ``skip`` and ``deeper``, in the units of the pairs of child nodes; pairs with an empty node are left out."""
    # masks: how a child of the other node may differ in the new bits
    masks = "array(0L)"
    for _ in range(max_bits):
        masks = (
            f"array_distinct(concat({masks}, flatten(transform({masks}, m -> "
            "transform(sequence(0, CAST(deeper AS INT) - 1), s -> m ^ shiftleft(1L, s))))))"
        )
    masks = f"filter({masks}, m -> bit_count(m) + bit_count(a ^ b) <= {max_bits})"
    split = F.expr("split + skip + deeper")
    child = F.expr(f"shiftrightunsigned(shiftleft(rot, {depth}), CAST(64 - split - skip - deeper AS INT))")
    cut = units.withColumns({"child": child, "mask": F.explode(F.expr(masks))})
    # the node across: in a pair of nodes its upper bits are the other node's
    mate = F.expr("IF(a = b, child, child ^ shiftleft(a ^ b, CAST(skip + deeper AS INT))) ^ mask")
    cut = cut.withColumn("mate", mate).select(
        "tree", "top", F.least("child", "mate").alias("a"), F.greatest("child", "mate").alias("b"), split.alias("split"),
        F.col("child").alias("node"), "rot", "id",
    )
    sides = cut.groupBy(*_UNIT).agg(F.min("node").alias("first"), F.max("node").alias("last"))
    both = sides.filter("a = b OR first < last").select(*_UNIT)
    return cut.join(both, _UNIT, "left_semi")


# --- components --------------------------------------------------------------------------------


def _with_least(links: DataFrame, salts: int) -> DataFrame:
    """The links ``(u, v)`` with the least neighbour ``m`` of u; the links of a node are dealt over ``salts`` tasks."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    if salts == 1:
        return links.join(least, "u")
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")).join(least, ["u", "salt"])


def _star_round(links: DataFrame, salts: int) -> DataFrame:
    """A large-star and a small-star step over links ``(u, v)`` with u > v."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _with_least(both, salts).filter("v > u")
    large = near.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
    near = _with_least(large, salts)
    moved = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.select("u", F.col("m").alias("v")).unionAll(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every linked node but the roots: the least node of its component.

    links: ``(u, v)`` of any orderable type. Rounds go on until a round changes nothing; each is a
    written table. The links of a node are dealt over as many tasks as the largest node needs to leave
    LINKS_OF_A_TASK to each; its minimum is pre-aggregated.
    """
    links = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        links = stage(links, "simhash-links")
        ends = links.select(F.explode(F.array("u", "v")).alias("node"), F.xxhash64("u", "v").alias("hash"))
        nodes = ends.groupBy("node").agg(F.count("*").alias("n"), F.sum(F.col("hash").cast("decimal(38,0)")).alias("hash"))
        *state, most = nodes.agg(F.sum("n"), F.sum("hash"), F.max("n")).first()
        if not most or state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        links = _star_round(links, 1 + most // LINKS_OF_A_TASK)


def near_duplicate_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    node_limit: int = NODE_LIMIT,
) -> DataFrame:
    """``near_duplicates`` with a fourth column ``root_fp``: the fingerprint that names the component.

    Two components may have the same smallest id where ids repeat; they never share a fingerprint.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle_words), "simhash-rows")
    classes = rows.groupBy("fp").agg(F.coalesce(F.min("id"), F.lit(_NO_ID)).alias("id"))
    classes = stage(classes, "simhash-classes")
    found = trie_links(classes, max_bits, node_limit).select(
        F.struct(F.col("id_a").alias("id"), F.col("fp_a").alias("fp")).alias("u"),
        F.struct(F.col("id_b").alias("id"), F.col("fp_b").alias("fp")).alias("v"),
    )
    moved = components(found).select(F.col("node.fp").alias("fp"), F.col("root.id").alias("root"), F.col("root.fp").alias("root_fp"))
    named = stage(
        classes.join(moved, "fp", "left").select(
            "fp", F.coalesce("root", "id").alias("component"), F.coalesce("root_fp", "fp").alias("root_fp")
        ),
        "simhash-named",
    )
    # a class may hold a third of all rows: both sides are files, so Spark splits the hot class's rows
    return rows.join(named, "fp", "left").select(
        F.col("id").alias("doc_id"), "fp", F.nullif(F.col("component"), F.lit(_NO_ID)).alias("component_id"), "root_fp"
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    node_limit: int = NODE_LIMIT,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row: its fingerprint and the smallest id reachable by links.

    Fingerprints link at ``max_bits`` or fewer differing bits. Equal fingerprints are one class before
    the join, so copies are never expanded into pairs. Defined cases: a null text counts as empty; texts
    without words share fingerprint zero; rows that repeat an id are rows of their own; a row without id
    links like any other but gives no id (its component has the smallest id of the others, or null);
    an empty table gives no rows; other columns, whatever their names, are not looked at.
    """
    found = near_duplicate_classes(docs, id_col, text_col, shingle_words, max_bits, node_limit)
    return found.select("doc_id", "fp", "component_id")


def keep_one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row of each component of near duplicates, with all its columns.

    The row with the smallest id stays (rows without id come last), of its rows the one with the smallest fingerprint, then
    that with the smallest hash of all columns. Defined cases: those of ``near_duplicates``; rows that share an id but are in different
    components are documents of their own; of rows without id one stays too, if no row of the component has an id;
    of rows that are equal in all columns one stays; columns of any name and type are carried along.

    Where ids tell rows apart, only the ids that go are joined, and Spark broadcasts them if they are few. Rows that
    share an id, or have none, are told apart by their fingerprints, which are made again for them.
    """
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    found = stage(near_duplicate_classes(numbered, key, text, shingle_words, max_bits), "near-dedup")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")
    first = found.groupBy("root_fp").agg(F.min(order).alias("row"))
    first = stage(first.select(F.col("row.doc_id").alias("first_id"), F.col("row.fp").alias("first_fp")), "near-dedup-first")
    of_ids = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("fp").alias("fp"))
    stays = (F.col("doc_id") == F.col("first_id")) & (F.col("fp") == F.col("first_fp"))
    single = of_ids.filter("n = 1").join(first, stays, "left_anti").select("doc_id", F.lit(False).alias("again"))
    apart = stage(single.unionAll(of_ids.filter("n > 1").select("doc_id", F.lit(True).alias("again"))), "near-dedup-apart")
    kept = numbered.join(apart.select("doc_id"), F.col(key).cast("long") == F.col("doc_id"), "left_anti").filter(F.col(key).isNotNull())
    repeated = apart.filter("again").select("doc_id")
    again = numbered.filter(F.col(key).isNull()).unionAll(numbered.join(repeated, F.col(key).cast("long") == F.col("doc_id"), "left_semi"))
    if not again.isEmpty():

        def work(texts):
            return {"fp": np.array([fingerprint(t, shingle_words) for t in texts], np.uint64).view(np.int64)}

        rows = per_text(again, again.columns, text, work, "fp long")
        chosen = rows.join(first, F.col(key).cast("long").eqNullSafe(F.col("first_id")) & (F.col("fp") == F.col("first_fp")), "left_semi")
        hashed = F.xxhash64(*[F.to_json(F.struct(c)) if isinstance(chosen.schema[c].dataType, (MapType, VariantType)) else F.col(c) for c in again.columns])
        chosen = stage(chosen.withColumn("hash", hashed), "near-dedup-chosen")
        least = chosen.groupBy(key, "fp").agg(F.min("hash").alias("hash"))
        same = F.expr(f"a.{key} <=> b.{key} AND a.fp = b.fp AND a.hash = b.hash")
        one = chosen.alias("a").join(least.alias("b"), same, "left_semi").dropDuplicates([key, "fp"])
        kept = kept.unionAll(one.select(*again.columns))
    return kept.toDF(*names)
