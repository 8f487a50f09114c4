"""Join texts by the Jaccard similarity of their word n-gram sets, with PartEnum signatures.

Sets are put into bands of nearly equal size. For each band the greatest number k of elements in which two
similar sets can differ is known, so the domain is cut into partitions by a hash, and signatures are the parts
of a set within subsets of partitions, chosen so that k differences cannot touch all of them (Arasu, Ganti and
Kaushik, Efficient Exact Set-Similarity Joins, 2006). Two similar sets share a signature for certain; sets
that share one are compared exactly.

Sets are the nodes, so exact copies are one node. Within a group of sets that share a signature each is
compared with the group's first set, and after that only with sets of other components of the group: no pair
whose outcome cannot matter is formed. What is left is compared inside the tasks, which pass on no more links than
join components. A task passes on one set of a group, so a group of any size is spread over the tasks that read it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkgraph.llm.batches import long_texts
from linkgraph.llm.components import connected_components
from linkgraph.llm.scratch import Scratch
from linkgraph.llm.words import binary, hash_words, lowered, mix, shingles
from linkgraph.session import scratch_path, written

MAX_SCHEMES = 4
FLUSH = 1 << 18  # signatures a task gathers before it passes them on
SETS_A_BATCH = 128  # sets that a task passes on at a time with their elements
BROADCAST_IDS = 2_000_000  # ids of 8 bytes that may be broadcast; more are joined by a shuffle


def bands(size: int, num: int, den: int) -> tuple[int, int, int]:
    """Index and bounds of the size band a set belongs to: sets similar by num/den are in this or the next one."""
    index, low = 0, 1
    while True:
        high = max(low, low * den // num)
        if size <= high:
            return index, low, high
        index, low = index + 1, high + 1


def plan(most: int, num: int, den: int) -> tuple[int, int, int] | None:
    """(partitions, parts of a partition, parts that may differ) for sets of at most ``most`` elements.

    None where similar sets must be equal. Small sets get larger subsets, so that their signatures stay rare.
    """
    k = 2 * most * (den - num) // (den + num)
    if k == 0:
        return None
    if k <= 2:
        return 1, k + 2, k
    if k <= 8:
        return k // 2 + 1, 3, 1
    return k + 1 + spare_parts(most, k, num, den), 1, 0


def spare_parts(most: int, k: int, num: int, den: int) -> int:
    """Partitions beyond those needed: as many as will seldom be empty in the smallest set of the two bands."""
    least = most * num * num / (den * den)
    empty = (k + 1) * math.exp(-least / (k + 1))
    return math.ceil(empty + 3 * math.sqrt(empty)) + 1


def _scheme(elements: np.ndarray, band: int, seed: int, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set under one hash of the domain, and whether each stands for an empty part."""
    first, second, differ = shape
    salt = mix(np.array([band * 1009 + seed + 1], dtype=np.uint64))
    spread = mix(elements ^ salt)
    cell = (spread % np.uint64(first * second)).astype(np.int64)
    sums = np.zeros(first * second, dtype=np.uint64)
    np.add.at(sums, cell, mix(spread))
    filled = np.bincount(cell, minlength=first * second).reshape(first, second)
    sums = sums.reshape(first, second)
    made, empty = [], []
    for number, subset in enumerate(combinations(range(second), second - differ)):
        part = sums[:, list(subset)].sum(axis=1, dtype=np.uint64)
        name = np.arange(first, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(number)
        made.append(mix(part + mix(name ^ salt)))
        empty.append(filled[:, list(subset)].sum(axis=1) == 0)
    return np.concatenate(made), np.concatenate(empty)


def signatures(elements: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of a set of 64-bit elements: any two sets with similarity num/den or more, not equal, share one.

    A part without elements is no signature, as sets with nothing in common would share it. A set with more
    empty parts than the spare ones gets a further scheme instead, and so does its partner, which has the same
    empty parts where the two agree in nothing else.
    """
    index, low, high = bands(len(elements), num, den)
    made = []
    for band, most in ((index, high), (index + 1, max(high + 1, (high + 1) * den // num))):
        shape = plan(most, num, den)
        if shape is None:
            continue
        spare = shape[0] - 1 - 2 * most * (den - num) // (den + num) if shape[2] == 0 else 0
        for seed in range(MAX_SCHEMES):
            names, empty = _scheme(elements, band, seed, shape)
            made.append(names[~empty])
            weak = int(empty.sum()) if shape[2] == 0 else int(empty.any())
            if weak <= spare:
                break
        else:
            made.append(names[empty])
    return np.unique(np.concatenate(made)) if made else np.empty(0, dtype=np.uint64)


def _node(elements: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(elements.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(digest, dtype=np.int64).tolist())


def text_sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``id``, ``n_shingles`` and the node (two halves of a hash of the set) of every row; no node without words."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(hash_words(lowered(text.as_py())), size) for text in binary(batch.column(1))]
            nodes = [_node(s) if len(s) else (None, None) for s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in found], pa.int64()),
                 pa.array([a for a, _ in nodes], pa.int64()), pa.array([b for _, b in nodes], pa.int64())],
                names=["id", "n_shingles", "node", "node2"])

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(
        sets, "id bigint, n_shingles bigint, node bigint, node2 bigint")


def _pairs_by_run(names: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted (name, node) rows, the first row of each row's name, and which rows are first."""
    first = np.concatenate([[True], names[1:] != names[:-1]])
    return np.flatnonzero(first)[np.cumsum(first) - 1], first


ROWS = "name bigint, node bigint, leader bigint"


def _signature_rows(docs: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int) -> DataFrame:
    def flush(names: list, nodes: list) -> Iterator[pa.RecordBatch]:
        name, node = (np.concatenate(part) if part else np.empty(0, dtype=np.int64) for part in (names, nodes))
        if not len(name):
            return
        order = np.lexsort((node, name))
        name, node = name[order], node[order]
        new = np.concatenate([[True], (name[1:] != name[:-1]) | (node[1:] != node[:-1])])
        name, node = name[new], node[new]
        lead, first = _pairs_by_run(name, node)
        for at in range(0, len(name), 1 << 17):
            part = slice(at, at + (1 << 17))
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[part].view(np.int64)), pa.array(node[part]), pa.array(node[lead[part]], mask=first[part])],
                names=["name", "node", "leader"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, nodes, gathered = [], [], 0
        for batch in batches:
            for text in binary(batch.column(0)):
                elements = shingles(hash_words(lowered(text.as_py())), size)
                own = signatures(elements, num, den) if len(elements) else elements
                names.append(own)
                nodes.append(np.full(len(own), _node(elements)[0] if len(own) else 0, dtype=np.int64))
                gathered += len(own)
                if gathered >= FLUSH:
                    yield from flush(names, nodes)
                    names, nodes, gathered = [], [], 0
        yield from flush(names, nodes)

    return docs.select(F.col(text_col).cast("string")).mapInArrow(sign, ROWS)


def shared_signatures(signed: DataFrame) -> DataFrame:
    """``name``, ``leader``, ``node`` of the signatures that several sets have; a leader is one of its sets."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_name, last_node = None, None  # first row of the name at hand
        for batch in batches:
            name, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            known = batch.column(2)
            told = ~np.asarray(known.is_null())
            leader = np.asarray(known.fill_null(0)).copy()
            open_rows = np.flatnonzero(~told)
            if len(open_rows):
                names, nodes = name[open_rows], node[open_rows]
                lead, first = _pairs_by_run(names, nodes)
                heads = nodes[lead]
                if last_name is not None:
                    heads = np.where(names == last_name, last_node, heads)
                leader[open_rows] = heads
                last_name, last_node = names[-1], heads[-1]
            keep = leader != node
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[keep]), pa.array(leader[keep]), pa.array(node[keep])], names=["name", "leader", "node"])

    # rows that lead their name within a task meet by name, the others know their leader and go anywhere
    place = F.when(F.col("leader").isNull(), F.col("name")).otherwise(F.col("node"))
    dealt = signed.repartition(place).sortWithinPartitions("name", "node")
    return dealt.mapInArrow(pair, "name bigint, leader bigint, node bigint")


def rows_with_ids(rows: DataFrame, column: str, ids: DataFrame, bound: int = BROADCAST_IDS) -> DataFrame:
    """Rows whose ``column`` is among ``ids`` (distinct, one column of 8 bytes), broadcast where they are few."""
    wanted = ids.toDF("__wanted")
    if wanted.limit(bound + 1).count() <= bound:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, F.col(column) == F.col("__wanted"), "left_semi")


def odd_sketch(elements: np.ndarray, cells: int = 1) -> bytes:
    """One bit for every cell of a hash, set where the cell has an odd number of elements.

    Every element in which two sets differ changes one bit at most, so the bits in which two sketches differ are
    never more than the elements in which the sets do, and with several ``cells`` for an element seldom many fewer
    (after Mitzenmacher, Pagh and Pham, 2014).
    """
    bits = max(256, cells << (len(elements) - 1).bit_length())
    cells = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((cells & 1).astype(np.uint8), bitorder="little").tobytes()


def _fold(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches (a row each) as sketches of fewer cells."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def _differ_at_most(n_a, n_b, num: int, den: int):
    """Elements in which two similar sets of these sizes can differ."""
    return (n_a + n_b) * (den - num) // (den + num)


def _sets_of(docs: DataFrame, id_col: str, text_col: str, size: int, reps: DataFrame) -> DataFrame:
    """``node``, ``n``, ``sketch``, ``fine`` (a larger sketch), ``elements`` of the texts whose ids are given."""

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SETS_A_BATCH):
                part = binary(batch.column(0).slice(at, SETS_A_BATCH))
                found = [shingles(hash_words(lowered(text.as_py())), size) for text in part]
                found = [s for s in found if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_node(s)[0] for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int64()),
                     pa.array([odd_sketch(s) for s in found], pa.binary()),
                     pa.array([odd_sketch(s, FINE) for s in found], pa.binary()),
                     pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                    names=["node", "n", "sketch", "fine", "elements"])

    chosen = rows_with_ids(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")),
                           "id", reps)
    return chosen.select(F.col("text").cast("string")).mapInArrow(
        elements, "node bigint, n bigint, sketch binary, fine binary, elements array<bigint>").dropDuplicates(["node"])


def _possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose sketches do not rule them out."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n_a, n_b, one, two in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                width = min(len(one), len(two))
                one, two = (_fold(np.frombuffer(x, dtype=np.uint8)[None], width) for x in (one, two))
                apart = int.from_bytes((one ^ two).tobytes(), "little").bit_count()
                keep.append(apart <= _differ_at_most(n_a, n_b, num, den))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "n_b", "s_a", "s_b")
    near = F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num
    return joined.where(near).mapInArrow(test, "a bigint, b bigint")


BLOCK = 4096  # members of a group that meet as one block
FINE = 4  # cells for an element of the sketches that decide which sets are compared within a group
COMPARED = 1 << 19  # 64-bit parts of sketches that a task compares at a time
BLOCK_ELEMENTS = 1 << 22  # elements of all sets of a block, on average


def _in_blocks(rows: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """``name, first, second, node, root, block`` and columns of the sets, every two blocks of a group together.

    ``rows`` has ``name``, ``blocks``, ``node``, ``root``. Each member meets those of its own block and of every other
    one, so no task holds more than two blocks.
    """
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (rows.withColumn("block", block)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
            .withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
            .join(sets.select("node", *columns), "node")
            .select("name", "first", "second", "node", "root", "block", *columns)
            .repartition("name", "first", "second").sortWithinPartitions("name", "first", "second"))


def _values(column: pa.Array) -> list:
    """The values of a column; lists of numbers as arrays, at a quarter of the memory of Python's numbers."""
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[a:b].copy() for a, b in zip(ends[:-1], ends[1:])]


def _by_block_pair(settle, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Call ``settle`` with the key and the other columns of each run of rows with the same first three columns."""
    held, key = [], None
    for batch in batches:
        for row in zip(*map(_values, batch.columns)):
            if row[:3] != key:
                if len(held) > 1:
                    yield from settle(key, *zip(*held))
                held, key = [], row[:3]
            held.append(row[3:])
    if len(held) > 1:
        yield from settle(key, *zip(*held))


def _near(open_rows: DataFrame, sets: DataFrame, num: int, den: int, nearest: bool) -> DataFrame:
    """Members of a group with a member of another component that their sketches do not rule out.

    With ``nearest`` the pairs ``a``, ``b`` of each such member and the one with the nearest sketch, otherwise the
    members as ``name, first, second, node``: in either case at most a row for each member of two blocks.
    """

    def settle(key, nodes, roots, blocks, sizes, sketches) -> Iterator[pa.RecordBatch]:
        nodes, roots, blocks, sizes = (np.array(x) for x in (nodes, roots, blocks, sizes))
        width = min(map(len, sketches))
        rows = np.concatenate([_fold(np.frombuffer(s, dtype=np.uint8)[None], width) for s in sketches]).view(np.uint64)
        step = max(1, COMPARED // max(1, rows.size))
        for at in range(0, len(nodes), step):
            part = slice(at, at + step)
            apart = np.bitwise_count(rows[part, None, :] ^ rows[None, :, :]).sum(axis=2, dtype=np.int64)
            may = apart <= _differ_at_most(sizes[part, None], sizes[None, :], num, den)
            may &= roots[part, None] != roots[None, :]
            if key[1] != key[2]:  # pairs within a block meet where the block meets itself
                may &= blocks[part, None] != blocks[None, :]
            if nearest:
                j = np.where(may, apart, np.iinfo(np.int64).max).argmin(axis=1)
                i = np.flatnonzero(may[np.arange(len(may)), j])
                one, two = nodes[part][i], nodes[j[i]]
                columns = {"a": np.minimum(one, two), "b": np.maximum(one, two)}
            else:
                own = nodes[part][may.any(axis=1)]
                columns = {"name": np.full(len(own), key[0]), "first": np.full(len(own), key[1], dtype=np.int32),
                           "second": np.full(len(own), key[2], dtype=np.int32), "node": own}
            if len(columns["node" if "node" in columns else "a"]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))

    dealt = _in_blocks(open_rows, sets, "n", "sketch" if nearest else "fine")
    schema = "a bigint, b bigint" if nearest else "name bigint, first int, second int, node bigint"
    return dealt.mapInArrow(lambda batches: _by_block_pair(settle, batches), schema)


def forest_of_similar(roots: list, blocks: list, elements: list, one_block: bool, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of sets, by place, that are similar and join two components: at most one less than there are sets.

    ``roots`` are the components at the beginning; pairs of one block are left out unless there is ``one_block``.
    """
    part = np.unique(np.array(roots), return_inverse=True)[1]
    blocks, sizes = np.array(blocks), np.array([len(e) for e in elements])
    flat = np.unique(np.concatenate(elements), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mark = np.zeros(int(flat.max()) + 1, dtype=bool)
    links = []
    for i in range(len(sizes) - 1):
        open_to = part[i + 1:] != part[i]
        if not one_block:
            open_to &= blocks[i + 1:] != blocks[i]
        if not open_to.any():
            continue
        own = flat[starts[i]:ends[i]]
        mark[own] = True
        common = np.add.reduceat(mark[flat[ends[i]:]], starts[i + 1:] - ends[i], dtype=np.int64)
        mark[own] = False
        alike = open_to & (common * (num + den) >= (sizes[i] + sizes[i + 1:]) * num)
        for j in (np.flatnonzero(alike) + i + 1).tolist():
            if part[j] != part[i]:
                links.append((i, j))
                part[part == part[j]] = part[i]
    return links


def _links_within(open_rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``a``, ``b`` of similar sets that join the components within two blocks of a group, compared in the task."""

    def settle(key, nodes, roots, blocks, elements) -> Iterator[pa.RecordBatch]:
        found = forest_of_similar(roots, blocks, list(elements), key[1] == key[2], num, den)
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(nodes[i], nodes[j]) for i, j in found], pa.int64()),
                 pa.array([max(nodes[i], nodes[j]) for i, j in found], pa.int64())], names=["a", "b"])

    near = _near(open_rows, sets, num, den, nearest=False)
    blocks = open_rows.select("name", "node", "root", "blocks")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (near.join(blocks, ["name", "node"]).withColumn("block", block).join(sets.select("node", "elements"), "node")
             .select("name", "first", "second", "node", "root", "block", "elements")
             .repartition("name", "first", "second").sortWithinPartitions("name", "first", "second"))
    return dealt.mapInArrow(lambda batches: _by_block_pair(settle, batches), "a bigint, b bigint").distinct()


def _similar(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are similar enough, compared exactly."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b")).cast("bigint")
    both = F.size("of_a").cast("bigint") + F.size("of_b")
    return (pairs.join(right, "b").join(left, "a")
            .where(common * (num + den) >= both * num).select("a", "b"))


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                     num: int = 8, den: int = 10) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` for every row of ``docs``.

    Rows link where den * intersection >= num * union of their sets of distinct ``size``-word shingles.
    ``component_id`` is the smallest id that links reach. A text with fewer words is one shingle; one without
    words, or a null, has an empty set and links with nothing, so its id is its component. Repeated rows and
    exact copies are one node and each get a row; a null id is never a component's id. An empty table gives no
    rows. Shingles and sets are told apart by 64-bit and 128-bit hashes.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    base = written(text_sets(long_texts(docs), id_col, text_col, size), scratch_path(spark, "sets"))
    nodes = base.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"))
    shared = scratch.write(shared_signatures(_signature_rows(docs, id_col, text_col, size, num, den)), "shared")

    pairs = shared.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
    candidates = pairs.select("a").union(pairs.select("b")).distinct().toDF("node")
    reps = scratch.write(nodes.join(candidates, "node").where("least IS NOT NULL").select("least").distinct(), "representatives")
    sets = scratch.write(_sets_of(docs, id_col, text_col, size, reps), "elements")
    links = scratch.write(_similar(_possible(pairs, sets, num, den), sets, num, den), "similar")
    roots = connected_components(links)

    # groups that still hold several components: first join each set to its nearest across components, as that
    # leaves few components, then compare all that is left
    groups = scratch.write(shared.select("name", "node").union(shared.select("name", F.col("leader").alias("node")))
                     .distinct(), "groups")
    for nearest in (True, False):
        open_rows = scratch.write(_open_groups(groups, roots, sets), "open")
        if nearest:
            more = _similar(_near(open_rows, sets, num, den, nearest).distinct(), sets, num, den)
        else:
            more = _links_within(open_rows, sets, num, den)
        more = scratch.write(more, "more")
        if more.limit(1).count():
            links = links.union(more)
            roots = connected_components(links)
        groups = open_rows.select("name", "node")
    scratch.drop()
    return _numbered(base, nodes, roots)


def _open_groups(groups: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """``name``, ``blocks``, ``node``, ``root`` of the groups with several components; equal groups once.

    ``blocks`` is into how many a group is cut, by its members and by their elements.
    """
    placed = groups.join(roots, "node", "left").select("name", "node", F.coalesce("root", "node").alias("root"))
    mixed = (placed.groupBy("name").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("mark2"))
        .where("low < high").groupBy("members", "mark", "mark2").agg(F.min("name").alias("name")))
    rows = placed.join(mixed.select("name"), "name")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_ELEMENTS))
    return rows.join(rows.join(sets.select("node", "n"), "node").groupBy("name").agg(blocks.alias("blocks")), "name")


def _numbered(base: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Every row with the smallest id of its component."""
    linked = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("node", "component_id")
    with_set = base.where("node IS NOT NULL").join(named, "node").select("id", "n_shingles", "component_id")
    return with_set.union(base.where("node IS NULL").select("id", "n_shingles", F.col("id").alias("component_id")))


def first_of_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows that are near copies of one with a smaller id; of repeated rows one stays.

    Rows without words stay, and so do rows with a null id. Rows that share an id but not the text are one
    document of several texts: they stay or go together.
    """
    found = ngram_components(docs, id_col, text_col, **settings)
    copies = found.where("id <> component_id").select("id").distinct().toDF("__id")
    kept = docs.join(copies, F.col(id_col) == F.col("__id"), "left_anti")
    repeated = found.where("id IS NOT NULL").groupBy("id").count().where("count > 1").select("id")
    if not repeated.limit(1).count():
        return kept
    again = repeated.toDF("__id")
    single = kept.join(again, F.col(id_col) == F.col("__id"), "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, F.col(id_col) == F.col("__id"), "left_anti").unionByName(single)
