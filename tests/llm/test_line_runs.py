"""Line dedup against all earlier places of a run."""

from collections import defaultdict

from assay.llm import line_dedup

SCHEMA = "doc_id long, text string"


def lines(name, *sizes):
    return ["\n".join(f"{name}{n}" + f" {name}" * (size - 1) for n, size in enumerate(sizes))]


def every_place(docs, min_words=50):
    seen, gone = defaultdict(list), {}
    for k, text in sorted(docs.items()):
        own, gone[k] = text.split("\n"), set()
        for p, line in enumerate(own):
            for other, q in seen[line]:
                there, n = docs[other].split("\n"), 0
                while p + n < len(own) and q + n < len(there) and own[p + n] == there[q + n]:
                    n += 1
                if sum(max(len(x.split()), 1) for x in own[p: p + n]) >= min_words:
                    gone[k] |= set(range(p, p + n))
            seen[line].append((k, p))
    return gone


def test_a_run_goes_whole_whichever_earlier_place_it_has(spark):
    p, q, r = lines("p", 60), lines("q", 40), lines("r", 7, 9, 12)
    docs = {
        1: p, 2: p + q, 3: p + q, 4: p + r, 5: lines("x", 3) + p + r + lines("y", 4),
        6: q + p + q, 7: r + q, 8: lines("z", 30) + r, 9: lines("z", 30) + r + q,
    }
    docs = {k: "\n".join(parts) for k, parts in docs.items()}
    found = line_dedup.dedup_lines(spark.createDataFrame(list(docs.items()), SCHEMA)).collect()
    gone = {r["doc_id"]: set(r["removed_lines"]) for r in found}
    assert gone[3] == {0, 1}
    assert gone == every_place(docs)
