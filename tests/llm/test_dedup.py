import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import components, exact_dedup, line_dedup, ngram_join, suffix_dedup

WORD = re.compile("[^ \t-\r]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def low(i):
    return -(2**63) if i is None else i


def test_exact_dedup_matches_grouping_by_text(docs_of, awkward, sample):
    rows = [r[:2] for r in sample[:100]] + [(i + 1000 if i else i, t) for i, t in awkward]
    got = exact_dedup.exact_dedup(docs_of(rows), block_bytes=64).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = sorted((str(i), str(max(groups[t or ""], key=low)), len(groups[t or ""]), sha(t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(low(r.doc_id) == low(r.keep_id) for r in got if r.kept)


def test_exact_dedup_plan_has_no_python(docs_of, sample):
    plan = exact_dedup.exact_dedup(docs_of(sample[:20]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_lines(rows, min_chars=20, min_docs=3):
    keys = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for i, t in rows:
        for x in (t or "").split("\n"):
            keys[key(x)].add(low(i))
    gone = lambda i, x: len(key(x)) >= min_chars and len(keys[key(x)]) >= min_docs and max(keys[key(x)]) != low(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if not gone(i, x)]
        out.append((str(i), len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out)


@pytest.mark.parametrize("min_docs", [2, 3, 4])
def test_line_dedup_matches_brute_force(docs_of, awkward, sample, min_docs):
    rows = [r[:2] for r in sample] + [(i + 1000 if i else i, t) for i, t in awkward]
    docs = docs_of(rows)
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_docs=min_docs)).withColumn("doc_id", line_dedup.null_id())
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in kept.collect()) == brute_lines(rows, min_docs=min_docs)


def test_line_dedup_of_a_line_that_fills_partitions(spark, docs_of):
    rows = [(i, f"the one line that every document has\nline of document number {i % 50}") for i in range(3000)]
    docs = docs_of(rows).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((str(r.doc), r.n_lines, r.n_dropped, r.kept_text) for r in kept) == brute_lines(rows)


def brute_components(rows, percent=75):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(low(i), least.get(find(k), 2**63))
    back = lambda v: None if v == -(2**63) else v
    return sorted((str(i), len(sets[k]), str(back(least[find(k)]))) for k, (i, _) in enumerate(rows))


def near_copies():
    words = [f"w{k}" for k in range(60)]
    out = []
    for i in range(120):  # copies of one text with one or two words changed, and chains of neighbours
        w = list(words)
        w[(i * 7) % 60] = f"x{i}"
        if i % 3 == 0:
            w[(i * 11 + 5) % 60] = f"y{i}"
        out.append((2000 + i, " ".join(w)))
    chain = [f"c{k}" for k in range(40)]
    return out + [(3000 + i, " ".join(chain[:i] + [f"z{k}" for k in range(i)] + chain[i:])) for i in range(20)]


def test_ngram_join_matches_brute_force(docs_of, awkward, sample):
    rows = [r[:2] for r in sample] + [(i + 1000 if i else i, t) for i, t in awkward] + near_copies()
    got = ngram_join.link_components(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows)


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, **{i: 200 for i in range(200, 209)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_joined_by_later_links(spark):
    first = [(i, i + 1) for i in range(0, 40, 2)] + [(100, 101)]
    later = [(i, i + 1) for i in range(1, 20, 2)] + [(41, 60), (60, 61), (101, 102), (0, 1)]
    table = lambda rows: spark.createDataFrame(rows, "a long, b long")
    both = components.joined_components(components.joined_components(None, table(first)), table(later))
    want = sorted(map(tuple, components.components(table(first + later)).collect()))
    assert sorted(map(tuple, both.collect())) == want
    again = components.joined_components(components.components(table(first)), table([]))
    assert again.count() == 2 * len(first)


def brute_suffixes(rows, length=100):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: low(r[0])):
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            g = b[k : k + length]
            if g in seen:
                gone[k : k + length] = [True] * length
            seen.add(g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((str(i), len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1, 4_000_000])
def test_suffix_dedup_matches_brute_force(docs_of, sample, block_bytes):
    passage = "a passage that is repeated word by word in several places of several documents, and is long enough to go " * 2
    rows = [r[:2] for r in sample[:60]] + [(900, None), (901, ""), (902, "x" * 500), (903, passage), (904, "before " + passage + "after"), (905, passage[3:] + passage), (None, "nul " * 60), (906, "abc" * 40)]
    got = suffix_dedup.remove_repeats(docs_of(rows), block_bytes=block_bytes).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_suffixes(rows)


def test_the_cover_is_a_perfect_difference_set():
    m = suffix_dedup.COVER_MODULUS
    assert {(a - b) % m for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(m))


def test_empty_tables(docs_of):
    none = docs_of([])
    assert exact_dedup.exact_dedup(none).count() == 0
    assert line_dedup.keep_bitmaps(none).count() == 0
    assert ngram_join.link_components(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_clashing_columns_do_no_harm(docs_of):
    rows = [(1, LINE * 3), (2, LINE * 3)]
    docs = docs_of(rows).select("*", *[F.lit(0).alias(c) for c in ("doc", "text_key", "pos", "uid", "block", "name", "token", "cid", "n", "kept", "label")])
    assert exact_dedup.exact_dedup(docs).where("kept").count() == 1
    assert {r.component_id for r in ngram_join.link_components(docs).collect()} == {1}
    assert line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).count() == 2
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_suffixes(rows)


LINE = "words enough for some shingles and for a string of a hundred bytes "
