"""URL filter and WARC archives against plain Python, and their odd inputs."""

import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assay.llm import fixed_values, url_filter, warc
from assay.llm.queries import labelled_urls
from assay.llm.shared import ship_package
from assay.session import new_run_root

PAGES = "page_id long, url string, html string, host string, score string, shard int, sha1 string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", "s", 1, "x") for i, u, h in rows], PAGES)


# --- url filter -------------------------------------------------------------------------------

URLS = [
    "http://www.example.com/en/1", "https://EXAMPLE.com/en/x?q=1", "http://example.com/de/",
    "http://sub.www.example.com/en/", "http://a.example.net/fr/2#top", "http://net/es/",
    "http://notnet/es/", "http://b.example.net/es", "http://b.example.net/de/9",
    "http://example.com", "http://example.com?x=/en/", "http://example.com/#/en/",
    "no scheme/en/", "http:/one.slash/", "", None, "a://b://c.com/en/", "http:///en/x",
    "http://ÄÖ.Example.COM/EN/", "http://x.org/a\nb/c", "http://.com/", "http://com/en/",
    "ftp://www.example.com/en/1", "http://cheap-pills.example.org/",
    "http://long.example.org/" + "a" * 20000,
]


def host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    fits = []
    for rule, verdict in fixed_values.URL_RULES:
        name, slash, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def judged(spark, rows, labelled=None):
    rules = spark.createDataFrame(fixed_values.URL_RULES, "rule string, verdict string")
    return url_filter.judge_urls(pages(spark, rows), rules, labelled, threshold=0.3)


def test_hosts_paths_and_rules_equal_plain_python(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, URLS[0], None), (3, URLS[3], None)]
    found = judged(spark, rows, labelled_urls(spark)).collect()
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r for r in found}
    for i, url, _ in rows:
        row, (host, path) = by_id[i], host_and_path(url)
        rule, verdict = rule_for(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule), url
        assert row["verdict"] == (verdict or ("block" if row["score"] >= 0.3 else "allow"))
        assert 0 <= row["score"] <= 1


def test_regression_tells_the_labelled_sites_apart(spark):
    model = url_filter.train(labelled_urls(spark))
    urls = labelled_urls(spark).select(
        F.col("host"), F.lit("/unseen/77").alias("path"), "blocked"
    )
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(url_filter.featured(urls)).select(
        "blocked", (vector_to_array("probability")[1] >= 0.3).alias("found")
    ).collect()
    assert sum(r["blocked"] == r["found"] for r in scored) / len(scored) > 0.97


def test_no_pages_no_labels_and_no_python(spark, plan_of):
    assert judged(spark, []).collect() == []
    one_label = judged(spark, [(1, "http://a.com/", None), (2, "http://a.org/", None)]).collect()
    assert {(r["page_id"], r["verdict"], r["score"]) for r in one_label} == {
        (1, "allow", None), (2, "allow", None),
    }
    both = judged(spark, [(1, "http://a.com/", None), (2, "http://a.net/es/x", None)])
    assert all(r["score"] is not None for r in both.collect())
    plan = plan_of(both)
    assert "Python" not in plan and "Arrow" not in plan


# --- archives ---------------------------------------------------------------------------------

def web_rows():
    bodies = ["<p>one</p>", "<p>two</p>", "", None, "ü" * 9, "<p>" + "long " * 60000 + "</p>"]
    rows = [(i, f"http://h{i}.org/ä b\r\nX: y", bodies[i % 6]) for i in range(40)]
    rows += [(100 + i, "http://hot.org/", "<p>hot</p>") for i in range(200)]
    rows += [(None, "http://no.id/", "<p>one</p>"), (None, None, "only without id"),
             (7, "http://h7.org/again", "<p>two</p>"), (2**60 + 1, None, "<p>hot</p>"),
             (900, "u", "same row"), (900, "u", "same row")]
    return rows


def expected_records(rows, least=0):
    firsts = {}
    for i, _, html in rows:
        key = (html or "").encode()
        if i is not None:
            firsts[key] = min(firsts.get(key, i), i)
        else:
            firsts.setdefault(key, 2**63)
    found = []
    for i, _, html in rows:
        payload = (html or "").encode()
        first = firsts[payload] if firsts[payload] < 2**63 else None
        response = len(payload) < least or i == first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        found.append((i, len(payload), digest, "response" if response else "revisit",
                      None if response else first))
    return sorted(found, key=str)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("least", [0, 6])
def test_archives_come_back(spark, least):
    rows, folder = web_rows(), new_run_root(spark, "warc")
    manifest = warc.write_archives(
        pages(spark, rows).repartition(3), folder, revisit_from=least,
        shard_bytes=200_000, file_bytes=4_000,
    )
    read = warc.read_archives(spark, folder, with_payload=True)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in read.collect()), key=str) == (
        expected_records(rows, least)
    )
    payloads = {r["page_id"]: bytes(r["payload"]) for r in read.where("payload IS NOT NULL").collect()}
    for i, _, html in rows:
        if i in payloads and i is not None:
            assert payloads[i] == (html or "").encode()
    files = manifest.collect()
    assert len({r["shard"] for r in files}) > 1 and len(files) > len({r["shard"] for r in files})
    for row in files:
        path = Path(folder, row["file"])
        data = path.read_bytes()
        assert (len(data), hashlib.sha1(data).hexdigest()) == (row["file_bytes"], row["sha1"])
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        assert row["records"] == 2 or row["file_bytes"] <= 4_000
    assert list(Path(folder, "temporary").iterdir()) == []


def test_same_pages_give_the_same_files(spark):
    def digests(parts):
        folder = new_run_root(spark, "warc")
        manifest = warc.write_archives(
            pages(spark, web_rows()).repartition(parts), folder, shard_bytes=200_000,
            file_bytes=4_000,
        )
        return {r["file"]: r["sha1"] for r in manifest.collect()}
    assert digests(1) == digests(6)


def test_shards_hold_ranges_and_no_id_or_missing_id_fills_one(spark, monkeypatch):
    """A third of the pages share an id, a third have none; the others lie in order of shards."""
    rows = [(i, f"http://h{i}.org/", f"<p>{i}</p>") for i in range(400)]
    rows += [(200, f"http://hot.org/{i}", f"<p>hot {i}</p>") for i in range(400)]
    rows += [(None, f"http://none.org/{i}", f"<p>none {i}</p>") for i in range(400)]
    folder = new_run_root(spark, "warc")
    manifest = warc.write_archives(pages(spark, rows), folder, shard_bytes=500)
    records = warc.read_archives(spark, folder).select("page_id", "target_uri", "file").collect()
    assert len(records) == len(rows)
    by_shard = {}
    for r in records:
        by_shard.setdefault(int(r["file"].split("-")[1]), []).append(r["page_id"])
    shards = len(by_shard)
    assert shards > 20
    assert max(ids.count(None) for ids in by_shard.values()) < 400 / shards * 4
    assert max(ids.count(200) for ids in by_shard.values()) < 400 / shards * 6
    ranges = [[i for i in by_shard[s] if i is not None] for s in sorted(by_shard)]
    for before, after in zip(ranges, ranges[1:]):
        assert not before or not after or max(before) <= min(after)
    assert sum(r["records"] for r in manifest.collect()) == len(rows) + manifest.count()


def test_shards_and_sample_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "MOST_SHARDS", 7)
    monkeypatch.setattr(warc, "MOST_SAMPLED", 50)
    many = spark.range(20_000).selectExpr("id AS page_id", "'u' AS url", "'text' AS payload")
    bounds = warc.shard_bounds(many, 10)
    assert len(bounds) == 6 and bounds == sorted(bounds)
    assert warc.shard_bounds(many.repartition(5), 10) == bounds
    assert warc.shard_bounds(many.limit(0), 10) == []
    assert warc.shard_bounds(many.selectExpr("CAST(NULL AS long) AS page_id", "url", "payload"), 10) == []


def test_publishing_twice_and_damage(spark):
    folder = new_run_root(spark, "warc")
    manifest = warc.write_archives(pages(spark, web_rows()[:5]), folder)
    name = manifest.first()["file"]
    path = Path(folder, name)
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 255
    path.write_bytes(bytes(data))
    with pytest.raises(Exception):
        warc.read_archives(spark, folder).collect()


def test_archives_of_nothing(spark):
    folder = new_run_root(spark, "warc")
    assert warc.write_archives(pages(spark, []), folder).collect() == []
    assert warc.read_archives(spark, folder).collect() == []
