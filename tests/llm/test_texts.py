"""Near-duplicates, line dedup, mixing and toxicity on small tables with odd rows."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import line_dedup, mixing, ngram_join, toxicity
from assay.llm.components import connected_components
from assay.llm.shared import ship_package

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "line string, node int, tokens string, score string, take int, doc string, block int"
)


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def documents(spark, rows):
    full = [
        (i, t, "en", s, None if t is None else len(t), "l", 1, "t", "s", 2, "d", 3)
        for i, t, s in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, words, vocabulary=4000):
    chosen = random.Random(seed)
    return [f"w{chosen.randrange(vocabulary)}" for _ in range(words)]


def edited(words, seed, changes):
    chosen = random.Random(seed)
    words = list(words)
    for _ in range(changes):
        words[chosen.randrange(len(words))] = f"e{chosen.randrange(10**6)}"
    return words


# --- near-duplicates --------------------------------------------------------------------------

def brute_links(rows):
    """Links between ids with different words, and classes, by comparing all pairs."""
    words = {}
    for i, text, _ in rows:
        if i is not None:
            words[i] = tuple(ngram_join.words_of(text))
    sets = {
        i: {w[k: k + 5] for k in range(max(len(w) - 4, 1))} if w else set()
        for i, w in words.items()
    }
    links, parent = set(), {i: i for i in words}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(words), 2):
        same = words[a] == words[b]
        both = len(sets[a] & sets[b])
        near = both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)
        if near and not same:
            links.add((a, b))
        if same or near:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return links, {i: root(i) for i in words}, Counter(words.values()), words


def near_rows():
    rows = []
    for base in range(12):
        words = prose(base, 120 + 40 * base)
        rows.append((len(rows), " ".join(words), "a"))
        for copy in range(base % 5):
            changed = edited(words, 100 * base + copy, 1 + copy * 2)
            rows.append((len(rows), " ".join(changed), "b"))
        rows.append((len(rows), " ".join(words).upper() + ".", "c"))
    rows += [(900 + i, t, "d") for i, t in enumerate([None, "", " \n", "one two", "one two", "one"])]
    rows += [(None, rows[0][1], "x"), (5, rows[5][1], "x"), (990, "long " + " ".join(prose(77, 30000)), "y")]
    return rows


def test_near_duplicates_equal_all_pairs(spark):
    rows = near_rows()
    found = {r["doc_id"]: r for r in ngram_join.near_duplicates(documents(spark, rows)).collect()}
    links, classes, copies, words = brute_links(rows)
    assert {i: r["class_id"] for i, r in found.items()} == classes
    assert {i: r["copies"] for i, r in found.items()} == {i: copies[w] for i, w in words.items()}
    degrees = defaultdict(set)
    for a, b in links:
        degrees[a].add(words[b])
        degrees[b].add(words[a])
    for i, row in found.items():
        assert bool(row["links"]) == bool(degrees[i])
        assert row["links"] <= len(degrees[i])


def test_links_that_miss_a_branch_s_smallest_node_are_found():
    """Two texts like each other whose branches are led by one that is like neither."""
    assert ngram_join.prefix_depth(0.8, 16, 6, 0.999) == 4
    assert ngram_join.prefix_depth(0.8, 16, 6, 0.9) == 6


def test_pairs_across_groups_are_all_compared(spark):
    forest = spark.createDataFrame(
        [(n, 0, bytes(12)) for n in range(6)], "node long, tree int, label binary"
    )
    groups = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "node long, component long")
    mixed = ngram_join.mixed_branches(forest, 4, groups)
    pairs = {(r["a"], r["b"]) for r in ngram_join.pairs_across(mixed).collect()}
    inside = {(0, 1), (0, 2), (1, 2)}
    assert pairs == set(itertools.combinations(range(6), 2)) - inside


def test_tiles_find_the_same_groups_as_pairs(spark):
    """Near copies of near copies: few are similar to the smallest, many to one another."""
    words, rows = prose(500, 150), []
    for i in range(60):
        words = edited(words, 7000 + i, 1 if i % 9 else 12)
        rows.append((i, " ".join(words), "s"))
    table = documents(spark, rows)
    nodes = ngram_join.stored(ngram_join.signed(table).withColumnRenamed("doc_id", "node"), "t")
    forest = nodes.select("node", F.posexplode("labels").alias("tree", "label"))
    none = spark.createDataFrame([], "node long, component long")
    links, classes, _, _ = brute_links(rows)
    for pairs_a_branch in (0, 10**9):
        found = ngram_join.links_across(forest, 4, none, nodes, table, 0.8, pairs_a_branch)
        pairs = {(r["a"], r["b"]) for r in found.collect()}
        assert pairs <= links
        groups = connected_components(found).collect()
        assert {r["node"]: r["component"] for r in groups} == {
            i: c for i, c in classes.items() if any(i in pair for pair in links)
        }
    mixed = ngram_join.mixed_branches(forest, 4, none)
    tiles = ngram_join.tiled_links(mixed, nodes, table, 0.8, tile_nodes=7)
    assert {(r["a"], r["b"]) for r in tiles.collect()} == links


def degrees_of(links, words):
    degrees = defaultdict(set)
    for a, b in links:
        degrees[a].add(words[b])
        degrees[b].add(words[a])
    return {i: len(degrees[i]) for i in words}


def test_links_are_all_similar_texts(spark):
    """Also inside groups whose texts are all similar to one another, or only in part."""
    rows = near_rows()
    words = prose(600, 200)
    rows += [(2000 + i, " ".join(edited(words, 8000 + i, 3)), "s") for i in range(30)]
    for i in range(40):
        words = edited(words, 9000 + i, 4)
        rows.append((3000 + i, " ".join(words), "t"))
    found = ngram_join.near_duplicates(documents(spark, rows)).collect()
    links, _, _, words = brute_links(rows)
    assert {r["doc_id"]: r["links"] for r in found} == degrees_of(links, words)


def test_tiles_count_the_same_links_as_pairs(spark):
    words, rows = prose(700, 150), []
    for i in range(50):
        words = edited(words, 6000 + i, 3)
        rows.append((i, " ".join(words), "s"))
    table = documents(spark, rows)
    nodes = ngram_join.stored(ngram_join.signed(table).withColumnRenamed("doc_id", "node"), "t")
    groups = nodes.select("node", F.lit(0).cast("long").alias("component"))
    links, _, _, words = brute_links(rows)
    degrees = {i: n for i, n in degrees_of(links, words).items() if n}
    for pairs_a_group in (0, 10**9):
        found = ngram_join.link_counts(groups, nodes, table, 0.8, pairs_a_group, tile_nodes=7)
        assert {r["node"]: r["links"] for r in found.collect()} == degrees


def test_one_of_each_group_stays(spark):
    rows = near_rows()
    _, classes, _, _ = brute_links(rows)
    table = documents(spark, rows)
    kept = ngram_join.keep_one_of_each(table)
    assert kept.columns == table.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([*set(classes.values()), None])


def test_near_duplicates_of_nothing(spark):
    assert ngram_join.near_duplicates(documents(spark, [])).collect() == []
    assert ngram_join.keep_one_of_each(documents(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    found = connected_components(spark.createDataFrame(chain + chain[:3], "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == (
        {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    )


# --- line dedup -------------------------------------------------------------------------------

def brute_lines(rows, min_words=50):
    """Lines to delete, from all long grams and plain comparison, without fingerprints."""
    docs = {}
    for i, text, _ in rows:
        docs[(i is None, i or 0, text or "")] = (text or "").split("\n")
    size = {k: [max(len(x.split()), 1) for x in lines] for k, lines in docs.items()}

    def end(k, p):
        total = 0
        for q in range(p, len(docs[k])):
            total += size[k][q]
            if total >= min_words:
                return q + 1
        return None

    first, gone = {}, defaultdict(set)
    places = [(k, p) for k in sorted(docs, key=lambda k: (k[0], k[1])) for p in range(len(docs[k]))]
    for k, p in places:
        e = end(k, p)
        if e is None:
            continue
        gram = tuple(docs[k][p:e])
        if gram not in first:
            first[gram] = (k, p)
            continue
        other, q = first[gram]
        stop, other_stop = e, q + e - p
        while (
            stop < len(docs[k]) and other_stop < len(docs[other])
            and docs[k][stop] == docs[other][other_stop]
            and sum(size[k][e:stop]) < min_words
        ):
            stop, other_stop = stop + 1, other_stop + 1
        gone[k] |= set(range(p, stop))
    return {k: gone.get(k, set()) for k in docs}


def passages():
    return ["\n".join(" ".join(prose(1000 + 10 * p + n, 8 + 9 * (n % 3))) for n in range(2 + p))
            for p in range(6)] + [" ".join(prose(2000, 55)), " ".join(prose(2001, 49))]


def line_rows():
    chosen, shared = random.Random(9), passages()
    rows = []
    for i in range(60):
        parts = [" ".join(prose(3000 + 50 * i + n, chosen.choice([3, 20, 60]))) for n in range(4)]
        for passage in chosen.sample(shared, chosen.randrange(4)):
            parts.insert(chosen.randrange(len(parts) + 1), passage)
        if i % 3 == 0:
            parts.insert(0, "A line that very many documents have.")
        rows.append((i, "\n".join(parts), "a"))
    rows += [
        (100, rows[3][1], "b"), (101, None, "c"), (102, "", "d"), (103, "\n\n\n", "e"),
        (None, rows[4][1], "f"), (7, rows[7][1], "g"),
        (104, "\n".join([" ".join(prose(1, 30))] * 9), "h"), (105, "x " * 30000, "i"),
        (106, "\n".join([""] * 120), "j"), (107, "\n".join([""] * 120 + ["z"]), "k"),
    ]
    return rows


def test_line_dedup_equals_brute_force(spark):
    rows = line_rows()
    table = documents(spark, rows)
    found = line_dedup.dedup_lines(table)
    assert found.columns == [*table.columns, "removed_lines"]
    expected = brute_lines(rows)
    results = found.collect()
    assert len(results) == len(rows)
    texts = {(i, s): t for i, t, s in rows}
    for row in results:
        before = texts[row["doc_id"], row["source"]]
        gone = expected[(row["doc_id"] is None, row["doc_id"] or 0, before or "")]
        assert set(row["removed_lines"]) == gone
        if before is None:
            assert row["text"] is None
        else:
            left = [x for n, x in enumerate(before.split("\n")) if n not in gone]
            assert row["text"] == "\n".join(left)


def test_passages_over_fifty_words_go_and_shorter_ones_stay(spark):
    long, short = " ".join(prose(1, 51)), " ".join(prose(2, 40))
    rows = [(i, f"{' '.join(prose(50 + i, 20))}\n{long}\n{' '.join(prose(90 + i, 9))}\n{short}", "s")
            for i in range(5)]
    found = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert {r["doc_id"]: r["removed_lines"] for r in found} == {0: [], 1: [1], 2: [1], 3: [1], 4: [1]}


def test_line_dedup_of_nothing_and_without_python(spark, plan_of):
    assert line_dedup.dedup_lines(documents(spark, [])).collect() == []
    plan = plan_of(line_dedup.dedup_lines(documents(spark, line_rows()[:5])))
    assert "Python" not in plan and "Arrow" not in plan


# --- mixing -----------------------------------------------------------------------------------

def mixing_rows():
    rows = []
    for source, count in (("big", 120), ("mid", 40), ("low", 12), (None, 6)):
        rows += [(len(rows) + i, " ".join(prose(len(rows) + i, 20 + i % 7)), source)
                 for i in range(count)]
    return rows + [(900, None, "big"), (901, "", "low"), (902, "", "empty"), (3, rows[3][1], "big"),
                   (None, "no id at all", "mid")]


def test_mixing_meets_the_repetition_limit(spark):
    rows = mixing_rows()
    table = documents(spark, rows)
    found = mixing.mix_sources(table, max_passes=3.0, block_tokens=100)
    assert found.columns[: len(table.columns)] == table.columns
    mixed = found.collect()
    tokens, given = Counter(), Counter()
    for row in mixed:
        tokens[row["source"]] += row["mix_tokens"]
    for i, text, source in rows:
        given[source] += len((text or "").split())
    passes = {s: tokens[s] / given[s] for s in given if given[s]}
    share = {s: given[s] / sum(given.values()) for s in passes}
    exponent = 1 - math.log(3) / math.log(max(share.values()) / min(share.values()))
    lowest = min(share[s] ** (exponent - 1) for s in share)
    for s in passes:
        wanted = share[s] ** (exponent - 1) / lowest
        assert wanted - 0.12 - 30 / given[s] <= passes[s] <= wanted + 1e-6
    assert passes["big"] == 1.0
    copies = Counter((r["doc_id"], r["text"], r["source"]) for r in mixed)
    wanted = Counter((i, t, s) for i, t, s in rows)
    assert all(copies[k] >= n for k, n in wanted.items())
    assert copies.keys() == wanted.keys()
    assert copies[(900, None, "big")] == 1 and copies[(902, "", "empty")] == 1


def test_mixing_spreads_sources_over_the_stream(spark):
    rows = [(i, " ".join(prose(i, 30)), "ab"[i % 3 > 0]) for i in range(900)]
    mixed = mixing.mix_sources(documents(spark, rows), max_passes=2.0, block_tokens=300)
    found = sorted((r["mix_position"], r["source"]) for r in mixed.collect())
    whole = sum(s == "a" for _, s in found) / len(found)
    half = [s for _, s in found[: len(found) // 2]]
    assert abs(sum(s == "a" for s in half) / len(half) - whole) < 0.05


def test_mixing_to_an_entropy_and_a_budget(spark):
    rows = [(i, "a b c d", f"s{min(i // 8, 3)}") for i in range(64)]
    keys = documents(spark, rows).select("source", F.lit(4).cast("long").alias("tokens"))
    goal = 1.3
    budgets = mixing.source_budgets(keys, max_passes=None, target_entropy=goal).collect()
    weights = [r["weight"] for r in budgets]
    assert abs(sum(weights) - 1) < 1e-9
    assert abs(-sum(w * math.log(w) for w in weights) - goal) < 1e-6
    small = mixing.mix_sources(
        documents(spark, rows), max_passes=1.0, budget_tokens=128.0, block_tokens=8
    ).collect()
    assert 96 <= sum(r["mix_tokens"] for r in small) <= 128
    assert max(Counter(r["doc_id"] for r in small).values()) == 1


def test_mixing_is_the_same_every_time_and_empty_for_nothing(spark):
    rows = mixing_rows()
    def run(parts):
        return Counter(tuple(r) for r in mixing.mix_sources(
            documents(spark, rows).repartition(parts), block_tokens=100
        ).collect())
    assert run(1) == run(5)
    assert mixing.mix_sources(documents(spark, [])).collect() == []
    weightless = documents(spark, [(1, None, "a"), (2, "", None)])
    assert len(mixing.mix_sources(weightless).collect()) == 2


# --- toxicity ---------------------------------------------------------------------------------

def toxic_rows(count=600):
    chosen, bad = random.Random(12), ["gruesome", "vileness", "hatefulx"]
    rows, labels = [], []
    for i in range(count):
        words = prose(i, 40)
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words[chosen.randrange(40)] = chosen.choice(bad)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, None, int(toxic)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_toxicity_finds_held_out_documents(spark):
    rows, labels = toxic_rows()
    odd = [(9000, None, "s"), (9001, "", "s"), (None, "gruesome", "s"),
           (9002, " ".join(prose(5, 90000)) + " vileness", "s"), (5, rows[5][1], "t")]
    table = documents(spark, rows + odd)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (9000, 1, None)], LABELS)
    found = toxicity.score_toxicity(table, marks).collect()
    assert len(found) == len(rows) + len(odd)
    scores = {r["doc_id"]: r for r in found}
    for i, _, toxic in labels:
        assert scores[i]["held_out"] == held_out(i)
        assert scores[i]["predicted"] == int(scores[i]["score"] >= 0.3)
    right = [scores[i]["predicted"] == t for i, _, t in labels if held_out(i)]
    assert np.mean(right) > 0.97
    rejected = [scores[i]["rejected"] == bool(t) for i, _, t in labels if held_out(i)]
    assert np.mean(rejected) > 0.97
    assert scores[9000]["score"] == scores[9001]["score"] and 0 <= scores[9000]["score"] <= 1
    assert scores[None]["held_out"] is False
    assert scores[9002]["score"] > 0.3
    kept = toxicity.keep_clean(table, marks)
    assert kept.columns == table.columns
    assert kept.count() == sum(not r["rejected"] for r in found)


def test_scores_do_not_depend_on_language_source_id_or_held_out_labels(spark):
    rows, labels = toxic_rows(200)
    marks = spark.createDataFrame(labels, LABELS)
    turned = spark.createDataFrame(
        [(i, q, 1 - t if held_out(i) else t) for i, q, t in labels], LABELS
    )
    table = documents(spark, rows)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(table, marks).collect()}
    other = toxicity.score_toxicity(table.withColumn("source", F.lit("z")), turned).collect()
    assert {r["doc_id"]: r["score"] for r in other} == scores


def test_long_texts_are_read_in_parts_like_short_ones(monkeypatch):
    texts = [toxicity.word_codes(" ".join(prose(i, n))) for i, n in enumerate([0, 1, 2, 3, 50, 333])]
    model = toxicity.starting_model(texts, np.array([0, 1, 0, 1, 0, 1.0]))
    whole = model.pooled(texts)
    monkeypatch.setattr(toxicity, "WORDS_A_STEP", 20)
    assert np.allclose(model.pooled(texts), whole, atol=1e-5)


def test_toxicity_without_labels_or_documents(spark):
    rows, labels = toxic_rows(20)
    none = spark.createDataFrame([], LABELS)
    assert toxicity.score_toxicity(documents(spark, rows), none).count() == 20
    clean = spark.createDataFrame([(i, 1, 0) for i, _, _ in labels], LABELS)
    assert toxicity.score_toxicity(documents(spark, rows), clean).count() == 20
    marks = spark.createDataFrame(labels, LABELS)
    assert toxicity.score_toxicity(documents(spark, []), marks).collect() == []


def test_threshold_lies_in_the_middle_of_the_gap():
    scores, labels = np.array([0.9, 0.8, 0.2, 0.1]), np.array([1.0, 1.0, 0.0, 0.0])
    assert toxicity.best_threshold(scores, labels) == pytest.approx(0.5)


def test_caps_do_not_change_the_odds(spark, monkeypatch):
    """A row of the sample weighs as many labelled rows as it stands for."""
    rows, labels = toxic_rows(400)
    marks, given = spark.createDataFrame(labels, LABELS), []
    monkeypatch.setattr(
        toxicity, "fit", lambda rows, stands_for=(1.0, 1.0): given.append((rows, stands_for))
    )
    toxicity.train_on(documents(spark, rows), marks, toxic_rows=50, clean_rows=60)
    (sample, stands_for), = given
    known = Counter(t for i, _, t in labels if not held_out(i))
    assert Counter(r["toxic"] for r in sample) == {1: 50, 0: 60}
    assert stands_for == pytest.approx((known[0] / 60, known[1] / 50))


def test_weights_count_like_repeated_rows():
    chosen = np.random.default_rng(4)
    labels = (np.arange(60) % 3 == 0).astype(float)
    scores = chosen.random(60) * 0.7 + 0.3 * labels * chosen.random(60)
    weights = np.where(labels == 1, 1.0, 4.0)
    times = weights.astype(int)
    assert toxicity.best_threshold(scores, labels, weights) == pytest.approx(
        toxicity.best_threshold(np.repeat(scores, times), np.repeat(labels, times))
    )
    texts = [toxicity.word_codes(" ".join(prose(i, 20))) for i in range(60)]
    model = toxicity.starting_model(texts, labels)
    toxicity.calibrate(model, texts, labels)
    before = model.score(texts).mean()
    toxicity.calibrate(model, texts, labels, weights)
    assert before == pytest.approx(1 / 3, abs=0.03)
    assert model.score(texts) @ weights / weights.sum() == pytest.approx(1 / 9, abs=0.03)
