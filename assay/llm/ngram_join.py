"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

The shingles of a document are its runs of five words. Texts of equal words are one node, named by
its smallest document id. Every tree of the forest labels a node with several MinHash values; the
labels sorted are a prefix trie. The longest prefixes are matched first and shortened until pairs
at the wanted similarity meet in some tree with the target recall. In every branch of the trie
each node is compared with the branch's smallest node, so a huge branch costs one comparison per
node. What then still lies in different groups of one branch is compared pair by pair: as rows in
small branches, and in tiles of two blocks of nodes in large ones, which give one link per node and
group instead of all pairs. Similar texts are then in one group, and all pairs of each group are
compared to count the links of its nodes; large groups are counted in tiles, so that no pairs are
written.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.components import connected_components
from assay.llm.shared import all_columns, stored, unused

WORD = re.compile(r"\w+")
SHINGLE_WORDS = 5
SIMILARITY = 0.8
TREES = 16
DEPTH = 6
TARGET_RECALL = 0.999
VALUE_BYTES = 2
PAIRS_A_BRANCH = 256
TILE_NODES = 256
REMEMBERED = 300_000
SHINGLES_A_STEP = 1 << 13
DOCUMENTS_A_STEP = 256
NUMBER_BUCKETS = 256


class WordHashes(dict):
    """A 64-bit hash per word, remembered while there is room."""

    def __missing__(self, word: str) -> int:
        data = word.encode()
        found = int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")
        if len(self) < REMEMBERED:
            self[word] = found
        return found


_hashes = WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingle_set(words: list[str], size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words are one shingle, no
    words none."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    runs = max(len(words) - size + 1, 1)
    found = np.zeros(runs, np.uint64)
    for step in range(min(size, len(words))):
        found = mixed(found * np.uint64(31) + hashes[step: step + runs] + np.uint64(step))
    return np.unique(found)


def permutations(count: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    top = np.iinfo(np.uint64).max
    factors = random.integers(1, top, count, dtype=np.uint64, endpoint=True) | np.uint64(1)
    return factors, random.integers(0, top, count, dtype=np.uint64, endpoint=True)


FACTORS, SHIFTS = permutations(TREES * DEPTH)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row per set; a set without shingles has the largest ones.

    The sets are laid end to end, so that a step takes several small ones or a part of a large one.
    """
    ends = np.cumsum([0, *map(len, sets)])
    lowest = np.full((len(FACTORS), len(sets)), np.iinfo(np.uint64).max, np.uint64)
    shingles = np.concatenate([np.empty(0, np.uint64), *sets])
    filled = np.flatnonzero(np.diff(ends))
    starts = ends[filled]
    for at in range(0, len(shingles), SHINGLES_A_STEP):
        part = shingles[at: at + SHINGLES_A_STEP]
        first = np.searchsorted(starts, at, "right") - 1
        last = np.searchsorted(starts, at + len(part))
        cuts, rows = np.maximum(starts[first:last] - at, 0), filled[first:last]
        for of_one, factor, shift in zip(lowest, FACTORS, SHIFTS, strict=True):
            found = np.minimum.reduceat(part * factor + shift, cuts)
            of_one[rows] = np.minimum(of_one[rows], found)
    return lowest.T


def labels_of(sets: list[np.ndarray]) -> list[list[bytes]]:
    """One label per set and tree: the low bytes of its mixed MinHash values, in order."""
    values, size = mixed(signatures(sets)).astype(">u2"), DEPTH * VALUE_BYTES
    rows = [row.tobytes() for row in np.ascontiguousarray(values)]
    return [[row[t * size: (t + 1) * size] for t in range(TREES)] for row in rows]


def prefix_depth(
    similarity: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH,
    recall: float = TARGET_RECALL,
) -> int:
    """Longest prefix at which a pair of the given similarity meets with the target recall."""
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


def signed(documents: DataFrame) -> DataFrame:
    """``doc_id, words_key, shingles, labels`` for every row with an id."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("words_key", pa.binary()), ("shingles", pa.int32()),
        ("labels", pa.list_(pa.binary())),
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS_A_STEP):
                part = batch.slice(at, DOCUMENTS_A_STEP)
                keys, sets = [], []
                for text in part.column(1).to_pylist():
                    words = words_of(text)
                    keys.append(hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest())
                    sets.append(shingle_set(words))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(keys, pa.binary()),
                    pa.array(list(map(len, sets)), pa.int32()),
                    pa.array(labels_of(sets), pa.list_(pa.binary())),
                ], schema=schema)

    return documents.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    ).mapInArrow(sign, "doc_id long, words_key binary, shingles int, labels array<binary>")


def shingled(documents: DataFrame) -> DataFrame:
    """``doc_id, words_key, grams``: the exact shingle sets."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("words_key", pa.binary()), ("grams", pa.list_(pa.int64())),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS_A_STEP):
                part = batch.slice(at, DOCUMENTS_A_STEP)
                texts = [words_of(text) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([
                        hashlib.blake2b(" ".join(w).encode(), digest_size=16).digest()
                        for w in texts
                    ], pa.binary()),
                    pa.array([shingle_set(w).view(np.int64) for w in texts],
                             pa.list_(pa.int64())),
                ], schema=schema)

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    ).mapInArrow(cut, "doc_id long, words_key binary, grams array<long>")


def gram_sets(needed: DataFrame, nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """``node, grams``: the exact shingle sets of the needed nodes."""
    wanted = nodes.join(needed, "node").select(F.col("node").alias("doc_id"), "words_key")
    texts = documents.select("doc_id", "text").join(wanted.select("doc_id"), "doc_id", "left_semi")
    return stored(
        shingled(texts).join(wanted, ["doc_id", "words_key"], "left_semi")
        .dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("node"), "grams"),
        "shingles",
    )


def verified(
    pairs: DataFrame, nodes: DataFrame, documents: DataFrame, similarity: float
) -> DataFrame:
    """The pairs ``a, b`` whose shingle sets have at least the given Jaccard similarity.

    ``nodes`` holds ``node, words_key, shingles``. Sizes rule most false pairs out before any set
    is built; sets are built for the nodes that are left.
    """
    sizes = nodes.select("node", "shingles")
    a, b = F.col("size_a"), F.col("size_b")
    possible = stored(
        pairs.join(sizes.toDF("a", "size_a"), "a").join(sizes.toDF("b", "size_b"), "b").where(
            (F.least(a, b) >= F.lit(similarity) * F.greatest(a, b)) & (F.least(a, b) > 0)
        ),
        "pairs",
    )
    needed = possible.select(F.col("a").alias("node")).union(possible.select("b")).distinct()
    sets = gram_sets(needed, nodes, documents)
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    return possible.join(sets.toDF("a", "grams_a"), "a").join(
        sets.toDF("b", "grams_b"), "b"
    ).where(both >= F.lit(similarity) * (a + b - both)).select("a", "b")


def branches(forest: DataFrame, depth: int) -> DataFrame:
    """Adds the trie branch of a node at a prefix length."""
    prefix = F.substring("label", 1, depth * VALUE_BYTES)
    return forest.withColumn("branch", F.concat(F.col("tree").cast("string").cast("binary"),
                                               F.lit("/").cast("binary"), prefix))


def smallest_pairs(forest: DataFrame, depth: int) -> DataFrame:
    """Every node with the smallest node of its branch."""
    at_depth = branches(forest, depth)
    # Written, so that the join's both sides are plain scans and a huge branch's partition is split.
    smallest = stored(
        at_depth.groupBy("branch").agg(
            F.min("node").alias("a"), F.max("node").alias("last")
        ).where("a <> last").select("branch", "a"),
        "branch-smallest",
    )
    return at_depth.join(smallest, "branch").where("node <> a").select(
        "a", F.col("node").alias("b")
    )


def mixed_branches(forest: DataFrame, depth: int, groups: DataFrame) -> DataFrame:
    """``branch, node, component, outside, others, total``: the nodes of the branches that hold
    several groups (``node, component``). ``outside`` are those not in the smallest group."""
    grouped = branches(forest, depth).join(groups, "node", "left").select(
        "branch", "node", F.coalesce("component", "node").alias("component")
    )
    low = stored(
        grouped.groupBy("branch").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        ).where("low <> high").select("branch", "low"),
        "branch-mixed",
    )
    rest = stored(
        grouped.join(low, "branch").withColumn("outside", F.col("component") > F.col("low")),
        "branch-nodes",
    )
    sizes = stored(
        rest.groupBy("branch").agg(
            F.count_if("outside").alias("others"), F.count(F.lit(1)).alias("total")
        ),
        "branch-sizes",
    )
    return rest.join(sizes, "branch")


def pairs_across(mixed_nodes: DataFrame) -> DataFrame:
    """All pairs of nodes that share one of the given branches but no group."""
    left = mixed_nodes.where("outside").select(
        "branch", F.col("node").alias("x"), F.col("component").alias("of_x")
    )
    right = mixed_nodes.select(
        "branch", F.col("node").alias("y"), F.col("component").alias("of_y")
    )
    return left.join(right, "branch").where("of_x <> of_y").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    ).distinct()


def near_masks(
    left: pd.Series, right: pd.Series, similarity: float
) -> Iterator[np.ndarray]:
    """For every shingle set on the left which sets on the right are similar. No set is empty."""
    sizes = np.array([len(grams) for grams in right])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    values, codes = np.unique(np.concatenate(right.to_list()), return_inverse=True)
    for grams in left:
        at = np.searchsorted(values, grams)
        at = at[np.take(values, at, mode="clip") == grams]
        held = np.zeros(len(values) + 1, np.int64)
        held[at] = 1
        both = np.add.reduceat(held[codes], starts)
        yield both >= similarity * (len(grams) + sizes - both)


def links_in_tile(left: pd.DataFrame, right: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """For every node on the left one similar node of every other group on the right."""
    found: list[tuple[int, int]] = []
    if len(left) and len(right):
        nodes, groups = right["node"].to_numpy(), right["component"].to_numpy()
        masks = near_masks(left["grams"], right["grams"], similarity)
        for node, group, mask in zip(left["node"], left["component"], masks, strict=True):
            near = mask & (groups != group)
            first: dict[int, int] = {}
            for other, name in sorted(zip(groups[near].tolist(), nodes[near].tolist())):
                first.setdefault(other, name)
            found += [(min(node, name), max(node, name)) for name in first.values()]
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def counts_in_tile(left: pd.DataFrame, right: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """``node, links``: how many nodes of the other block are similar to each node of a block, or
    how many others of its own, if both blocks are the same."""
    if not len(left) or not len(right):
        return pd.DataFrame({"node": [], "links": []}, dtype=np.int64)
    nodes = right["node"].to_numpy()
    own = np.zeros(len(left), np.int64)
    others = np.zeros(len(right), np.int64)
    masks = near_masks(left["grams"], right["grams"], similarity)
    for i, (node, mask) in enumerate(zip(left["node"], masks, strict=True)):
        near = mask & (nodes != node)
        own[i] = near.sum()
        others += near
    found = pd.DataFrame({"node": left["node"].to_numpy(), "links": own})
    if left["block"].iloc[0] != right["block"].iloc[0]:
        found = pd.concat([found, pd.DataFrame({"node": nodes, "links": others})])
    return found[found["links"] > 0]


def tiled_links(
    mixed_nodes: DataFrame, nodes: DataFrame, documents: DataFrame, similarity: float,
    tile_nodes: int = TILE_NODES,
) -> DataFrame:
    """Verified links between groups of the given branches, block against block."""
    sets = gram_sets(mixed_nodes.select("node").distinct(), nodes, documents)

    def blocks(count: str) -> Column:
        return F.greatest(F.ceil(F.col(count) / F.lit(tile_nodes)), F.lit(1))

    block = F.xxhash64("node")
    last = F.lit(1).cast("long")
    rows = stored(
        mixed_nodes.select(
            "branch", "node", "component", "outside",
            blocks("others").alias("left_blocks"), blocks("total").alias("right_blocks"),
        ).join(sets, "node"),
        "branch-sets",
    )
    left = rows.where("outside").select(
        "branch", "node", "component", "grams",
        F.pmod(block, "left_blocks").alias("left_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("right_blocks") - last)).alias(
            "right_block"
        ),
    )
    right = rows.select(
        "branch", "node", "component", "grams",
        F.pmod(block, "right_blocks").alias("right_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("left_blocks") - last)).alias(
            "left_block"
        ),
    )
    tile = ("branch", "left_block", "right_block")
    return left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(
        lambda a, b: links_in_tile(a, b, similarity), "a long, b long"
    ).distinct()


def links_across(
    forest: DataFrame, depth: int, groups: DataFrame, nodes: DataFrame, documents: DataFrame,
    similarity: float, pairs_a_branch: int = PAIRS_A_BRANCH,
) -> DataFrame:
    """Links between nodes that share a branch but no group yet; each such pair is compared."""
    mixed_nodes = stored(mixed_branches(forest, depth, groups), "branch-rest")
    few = F.col("others") * F.col("total") <= pairs_a_branch
    as_rows = verified(pairs_across(mixed_nodes.where(few)), nodes, documents, similarity)
    many = mixed_nodes.where(~few)
    return as_rows.union(tiled_links(many, nodes, documents, similarity)).distinct()


def tiled_counts(
    grouped: DataFrame, nodes: DataFrame, documents: DataFrame, similarity: float,
    tile_nodes: int = TILE_NODES,
) -> DataFrame:
    """``node, links`` of the groups ``component, node, size``, block against block."""
    sets = gram_sets(grouped.select("node"), nodes, documents)
    count = F.ceil(F.col("size") / F.lit(tile_nodes))
    rows = stored(
        grouped.select(
            "component", "node", count.alias("blocks"),
            F.pmod(F.xxhash64("node"), count).alias("block"),
        ).join(sets, "node"),
        "group-sets",
    )
    zero, last = F.lit(0).cast("long"), F.col("blocks") - 1
    left = rows.withColumn("right_block", F.explode(F.sequence("block", last))).withColumn(
        "left_block", F.col("block")
    )
    right = rows.withColumn("left_block", F.explode(F.sequence(zero, "block"))).withColumn(
        "right_block", F.col("block")
    )
    tile = ("component", "left_block", "right_block")
    columns = (*tile, "node", "block", "grams")
    return left.select(*columns).groupBy(*tile).cogroup(
        right.select(*columns).groupBy(*tile)
    ).applyInPandas(lambda a, b: counts_in_tile(a, b, similarity), "node long, links long")


def link_counts(
    groups: DataFrame, nodes: DataFrame, documents: DataFrame, similarity: float,
    pairs_a_group: int = PAIRS_A_BRANCH, tile_nodes: int = TILE_NODES,
) -> DataFrame:
    """``node, links``: to how many nodes of its group (``node, component``) a node is similar.

    All pairs of a group are compared, once each: as rows in small groups, in tiles in large ones.
    Two nodes alone are linked to each other.
    """
    sizes = stored(
        groups.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "group-sizes"
    )
    grouped = stored(groups.join(sizes, "component").select("component", "node", "size"), "grouped")
    two = grouped.where("size = 2").select("node", F.lit(1).cast("long").alias("links"))
    more = F.col("size") > 2
    few = F.col("size") * (F.col("size") - 1) <= 2 * pairs_a_group
    small = grouped.where(more & few)
    pairs = small.select("component", F.col("node").alias("a")).join(
        small.select("component", F.col("node").alias("b")), "component"
    ).where("a < b").select("a", "b")
    linked = verified(pairs, nodes, documents, similarity)
    counted = two.union(
        linked.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long"))
    ).union(tiled_counts(grouped.where(more & ~few), nodes, documents, similarity, tile_nodes))
    return stored(counted.groupBy("node").agg(F.sum("links").alias("links")), "link-counts")


def linked_nodes(
    documents: DataFrame, similarity: float, recall: float
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``members`` (doc_id, words_key), ``leaders`` (words_key, node, copies), ``nodes`` with
    shingles, and ``groups`` (node, component) of those with links."""
    rows = stored(signed(documents), "signatures")
    ids = rows.groupBy("doc_id").agg(F.min("words_key").alias("words_key"))
    members = stored(ids, "members")
    leaders = members.groupBy("words_key").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")
    )
    leaders = stored(leaders, "leaders")
    named = leaders.select(F.col("node").alias("doc_id"), "words_key")
    nodes = stored(
        rows.where("shingles > 0").join(named, ["doc_id", "words_key"], "left_semi")
        .dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "node"),
        "nodes",
    )
    depth = prefix_depth(similarity, recall=recall)
    trees = nodes.select("node", F.posexplode("labels").alias("tree", "label"))
    # Most nodes are alone in most branches; those rows end here.
    shared = stored(
        branches(trees, depth).groupBy("branch").agg(
            F.min("node").alias("first"), F.max("node").alias("last")
        ).where("first <> last").select("branch"),
        "branch-shared",
    )
    forest = stored(
        branches(trees, depth).join(shared, "branch", "left_semi").select("node", "tree", "label"),
        "forest",
    )
    candidates = smallest_pairs(forest, DEPTH)
    for shorter in range(DEPTH - 1, depth - 1, -1):
        candidates = candidates.union(smallest_pairs(forest, shorter))
    first = stored(
        verified(candidates.distinct(), nodes, documents, similarity), "links-first"
    )
    groups = connected_components(first)
    second = stored(
        links_across(forest, depth, groups, nodes, documents, similarity), "links-rest"
    )
    links = first.union(second).distinct()
    if not second.isEmpty():
        groups = connected_components(links)
    return members, leaders, nodes, groups


def classes_of(leaders: DataFrame, groups: DataFrame) -> DataFrame:
    """``leaders`` with ``class_id``, the smallest node that theirs reaches."""
    return leaders.join(groups, "node", "left").select(
        "node", "words_key", "copies", F.coalesce("component", "node").alias("class_id")
    )


def near_duplicates(
    documents: DataFrame, similarity: float = SIMILARITY, recall: float = TARGET_RECALL
) -> DataFrame:
    """``doc_id, class_id, links, copies`` for every id of ``documents``.

    ``class_id`` is the smallest id that the document reaches by links of at least ``similarity``
    (Jaccard, runs of five words, letters lower-cased) and by equal words. ``links`` counts the
    other texts of its class that are similar to it, each text of equal words once; all pairs of a
    class are compared. ``copies`` counts the ids
    with the same words. Texts of fewer than five words are one shingle; NULL and empty texts have
    no words and are copies of each other. Rows without id have no result. Rows of one id count
    once; if their texts differ, the one with the smallest hash is compared. Other columns than
    ``doc_id`` and ``text`` are not read.
    """
    members, leaders, nodes, groups = linked_nodes(documents, similarity, recall)
    degrees = link_counts(groups, nodes, documents, similarity)
    classes = classes_of(leaders, groups).join(degrees, "node", "left").select(
        "words_key", "copies", "class_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )
    return members.join(classes, "words_key").select("doc_id", "class_id", "links", "copies")


def text_key(text: Column) -> Column:
    """128 bits of a text; NULL has a key of its own."""
    return F.md5(F.coalesce(F.concat(F.lit("="), text), F.lit("")))


def further_texts(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, node``: the texts of an id beyond the one with the smallest key, each
    with a number of its own above all ids."""
    keyed = documents.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key")
    )
    several = stored(
        keyed.groupBy("doc_id").agg(
            F.min("text_key").alias("first"), F.max("text_key").alias("last")
        ).where("first <> last").select("doc_id", "first"),
        "several-texts",
    )
    others = stored(
        keyed.join(several, "doc_id").where("text_key <> first").select("doc_id", "text_key")
        .distinct().withColumn(
            "bucket", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(NUMBER_BUCKETS))
        ),
        "further-texts",
    )
    # At most NUMBER_BUCKETS rows.
    sizes = {row["bucket"]: row["count"] for row in others.groupBy("bucket").count().collect()}
    top = documents.agg(F.max(F.col("doc_id").cast("long"))).first()[0] or 0
    if top + sum(sizes.values()) >= 2 ** 63:
        raise ValueError("ids are too large to number the further texts of ids with several")
    before, starts = top, []
    for bucket in range(NUMBER_BUCKETS):
        starts.append(before)
        before += sizes.get(bucket, 0)
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("doc_id", "text_key"))
    start = F.element_at(F.array(*map(F.lit, starts)), F.col("bucket").cast("int") + 1)
    return others.select(
        "doc_id", "text_key", (start.cast("long") + place).alias("node")
    )


def keep_one_of_each(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows whose text names its class, once each, with all columns.

    Classes are those of ``near_duplicates``, but every text of an id is judged by itself: of a
    class the row with the smallest id stays. Texts of an id beyond one come after all ids. Rows
    equal in id and text stay once, whichever their other columns; rows without id stay. NULL and
    empty texts are copies of each other. Other columns may have any name. No rows: no result.
    """
    found = stored(further_texts(documents), "further-nodes")
    id_name, key_name = unused(documents, "own_id"), unused(documents, "own_key")
    own = documents.withColumns({
        id_name: F.col("doc_id").cast("long"), key_name: text_key(F.col("text"))
    })
    named = own.where(F.col(id_name).isNotNull())
    judged = documents
    if not found.isEmpty():
        names = found.toDF(id_name, key_name, node_name := unused(own, "own_node"))
        named = named.join(names, [id_name, key_name], "left").withColumn(
            id_name, F.coalesce(node_name, id_name)
        )
        judged = stored(named.select(F.col(id_name).alias("doc_id"), "text"), "texts-by-node")
    members, leaders, _, groups = linked_nodes(judged, similarity, TARGET_RECALL)
    kept = members.join(classes_of(leaders, groups), "words_key").where(
        "doc_id = class_id"
    ).select(F.col("doc_id").alias(id_name))
    columns = all_columns(documents)
    once = named.join(kept, id_name, "left_semi").dropDuplicates([id_name])
    return once.select(*columns).unionByName(
        own.where(F.col(id_name).isNull()).select(*columns)
    )
