"""Exact copies, repeated line runs and near duplicates against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from saldero.llm import exact_index, graph, line_runs, near_duplicates
from saldero.llm.frames import byte_slices
from saldero.session import scratch_path

SCHEMA = "doc_id long, text string, digest string, row int, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "d", n, "x") for n, (i, t) in enumerate(rows)], SCHEMA)


# Exact copies

COPIES = [
    (1, "a"), (5, "a"), (3, "a"), (2, None), (9, ""), (None, "a"), (None, "n"), (None, "n"),
    (7, "b"), (7, "b"), (8, "b "), (10, "é"), (11, "x" * 200_000), (12, "x" * 200_000),
]


def marked(spark, rows, **options):
    path = scratch_path(spark, "index")
    return exact_index.mark_copies(table(spark, rows), path, **options).collect()


@pytest.mark.parametrize("arrivals", [1, 2])
def test_later_loads_keep_only_new_texts(spark, arrivals):
    path, first = scratch_path(spark, "index"), [(1, "a"), (2, "b"), (2, "b"), (3, None)]
    options = {"arrivals": arrivals, "buckets": 2}
    exact_index.mark_copies(table(spark, first), path, **options)
    again = exact_index.mark_copies(table(spark, first), path, **options).collect()
    assert [r["kept"] for r in again] == [False] * 4
    assert sorted((r["id"], r["keep_id"]) for r in again) == [(1, 1), (2, 2), (2, 2), (3, 3)]
    second = [(9, "a"), (8, "c"), (7, ""), (6, "c"), (2, "b"), (None, "d")]
    left = exact_index.drop_copies(table(spark, second), path, **options).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == [(0, "d"), (8, "c")]


@pytest.mark.parametrize("arrivals", [1, 2, 5])
def test_largest_id_of_equal_texts_stays(spark, arrivals):
    found = marked(spark, COPIES, arrivals=arrivals, buckets=2)
    groups = {}
    for i, text in COPIES:
        groups.setdefault(text or "", []).append(i)
    assert len(found) == len(COPIES)
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        mine = [r for r in found if r["digest"] == digest]
        best = max((i for i in ids if i is not None), default=None)
        assert {(r["keep_id"], r["group_size"]) for r in mine} == {(best, len(ids))}
        assert [r["id"] for r in mine if r["kept"]] == [best]


def test_index_outlives_its_session_name(spark):
    path = scratch_path(spark, "index")
    first = exact_index.DigestIndex(spark, path, 2)
    first.add(exact_index.digests(table(spark, [(1, "a"), (2, "b")])))
    first.close()
    later = exact_index.DigestIndex(spark, path, 2)
    later.add(exact_index.digests(table(spark, [(9, "b"), (8, "c"), (7, "c")])))
    assert sorted(r["owner_id"] for r in later.rows().collect()) == [1, 2, 8]


def test_index_is_not_shuffled_by_the_anti_join(spark):
    index = exact_index.DigestIndex(spark, scratch_path(spark, "index"), 2)
    index.add(exact_index.digests(table(spark, COPIES)))
    own = index.rows()
    plan = own.hint("merge").join(own.select("digest"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_dropping_copies_keeps_columns_and_one_row_each(spark):
    path = scratch_path(spark, "index")
    left = exact_index.drop_copies(table(spark, COPIES), path)
    assert left.columns == ["doc_id", "text", "digest", "row", "id"]
    kept = sorted((r["doc_id"] or 0, (r["text"] or "")[:3]) for r in left.collect())
    assert kept == [(0, "n"), (5, "a"), (7, "b"), (8, "b "), (9, ""), (10, "é"), (12, "xxx")]


def test_empty_table_has_no_copies(spark):
    assert marked(spark, []) == []


# Repeated line runs


def removed_by_hand(rows, length):
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0))
    for n in order:
        lines = rows[n][1].split("\n") if rows[n][1] else []
        gone = set()
        for p in range(len(lines) - length + 1):
            run = tuple(lines[p : p + length])
            if run in seen:
                gone.update(range(p, p + length))
            seen.add(run)
        kept = [x for p, x in enumerate(lines) if p not in gone]
        out[n] = ("\n".join(kept), len(lines), len(gone))
    return out


def run_rows():
    draw = random.Random(3)
    rows = [(i, "\n".join(draw.choice("abcde") for _ in range(draw.randint(1, 14)))) for i in range(40)]
    rows += [(100, "p\nq\nr\ns\nt\nu"), (101, "z\nq\nr\ns\nt\ny"), (102, "k\nk\nk\nk\nk"), (103, "")]
    return rows + [(104, None), (None, "p\nq\nlast"), (105, "\n\n\n"), (106, "m\n" * 3000)]


@pytest.mark.parametrize("length", [1, 2, 4])
def test_later_copies_of_runs_are_removed(spark, length):
    rows = run_rows()
    found = line_runs.remove_repeated_runs(table(spark, rows), min_lines=length).collect()
    expected = removed_by_hand(rows, length)
    assert {r["row"]: (r["kept_text"], r["n_lines"], r["n_removed"]) for r in found} == expected
    assert {r["digest"] for r in found} == {"d"}


@pytest.mark.parametrize("length", [2, 4])
def test_long_lines_count_as_runs_of_one(spark, length):
    passage = "a passage that stands alone"
    rows = [*run_rows(), (200, f"1\n{passage}\n2\nf"), (201, f"3\n{passage}\n4"), (202, f"{passage}\n{passage}")]
    rows += [(203, passage), (204, passage[:-1]), (205, passage[:-1]), (206, "f")]
    frame = table(spark, rows)
    found = line_runs.remove_repeated_runs(frame, min_lines=length, long_line=len(passage)).collect()
    expected = removed_by_hand(rows, length)
    for n, (i, text) in enumerate(rows):
        if i in (201, 202, 203):
            lines = text.split("\n")
            left = [x for x in lines if x != passage]
            expected[n] = ("\n".join(left), len(lines), len(lines) - len(left))
    assert {r["row"]: (r["kept_text"], r["n_lines"], r["n_removed"]) for r in found} == expected
    repeats = {r["doc_id"]: r["longest_repeat"] for r in found}
    assert [repeats[i] for i in (200, 203, 204, 206)] == [1, 1, 0, 0]


def test_longest_repeat_is_a_power_of_two(spark):
    rows = [(1, "a\nb\nc\nd\ne\nf"), (2, "x\na\nb\nc\nd\ne"), (3, "lone")]
    found = line_runs.remove_repeated_runs(table(spark, rows)).orderBy("doc_id").collect()
    assert [r["longest_repeat"] for r in found] == [4, 4, 0]


def test_rows_that_repeat_id_and_text_are_one_document(spark):
    found = line_runs.remove_repeated_runs(table(spark, [(1, "a\nb"), (1, "a\nb")])).collect()
    assert [r["n_removed"] for r in found] == [0, 0]


def test_runs_of_an_empty_table(spark):
    assert line_runs.remove_repeated_runs(table(spark, [])).count() == 0


def test_line_runs_use_no_python(spark):
    plan = line_runs.remove_repeated_runs(table(spark, run_rows()))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", text)


# Near duplicates


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def components_by_hand(rows):
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None and shingles(t)]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}


def near_rows():
    draw = random.Random(5)
    rows, words = [], [f"w{k}" for k in range(400)]
    for family in range(12):
        base = [draw.choice(words) for _ in range(draw.randint(30, 120))]
        for _ in range(draw.randint(1, 9)):
            copy = list(base)
            for _ in range(draw.randint(0, 5)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append(" ".join(copy))
    chain = [f"c{k}" for k in range(160)]
    rows += [" ".join(chain[k : k + 100]) for k in range(0, 60, 10)]
    rows += ["One two", "one  TWO", "one two three", "", None, " \t", "Ünï ÜNÏ", "ünï ünï", "a b c d e"]
    rows += [" ".join(draw.choice(words) for _ in range(30_000))] * 2
    order = list(range(len(rows)))
    draw.shuffle(order)
    return [(10 * i, t) for i, t in zip(order, rows, strict=True)] + [(None, "one two")]


def test_components_equal_brute_force(spark):
    rows = near_rows()
    found = near_duplicates.near_duplicates(table(spark, rows)).collect()
    expected, texts = components_by_hand(rows), dict(rows)
    assert len(found) == len(rows)
    for r in found:
        assert r["n_shingles"] == len(shingles(texts[r["doc_id"]]))
        assert r["component_id"] == expected.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_short_texts_and_empty_tables(spark):
    assert near_duplicates.near_duplicates(table(spark, [])).count() == 0
    found = near_duplicates.near_duplicates(table(spark, [(4, ""), (3, None), (2, "x")])).collect()
    assert sorted((r["doc_id"], r["component_id"], r["n_shingles"]) for r in found) == [
        (2, 2, 1), (3, 3, 0), (4, 4, 0),
    ]


def test_bound_keeps_pairs_at_the_threshold():
    steps = near_duplicates.Settings().least_matches()
    assert [n for n, _ in steps] == [40, 80, 120, 160, 200, 240]
    assert all(least < 0.75 * n for n, least in steps)
    assert steps[-1][1] / 240 > 0.5


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r["u"]: r["v"] for r in found} == {k: 0 for k in range(1, 51)} | {
        k: 100 for k in range(101, 160)
    }


def test_every_slice_of_a_batch_has_its_own_sets():
    texts = pa.array([f"Ääé {k} b{k} C d{k} E f" for k in range(300)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    sliced = [
        s
        for part in byte_slices(batch, 0, 500)
        for s in near_duplicates.shingle_sets(part.column(0), 5)
    ]
    whole = near_duplicates.shingle_sets(texts, 5)
    assert all((a == b).all() for a, b in zip(sliced, whole, strict=True))


def test_pairs_that_differ_by_a_frequent_passage(spark):
    """Shares around 1/3 and 1/2, one set a part of the other, exactly at or above the threshold."""
    passage = [f"p{k}" for k in range(260)]
    rows = [(n, " ".join([*passage, *(f"holder{n}x{k}" for k in range(400))])) for n in range(10)]
    for n, (shared, longer) in enumerate([(97, 196), (100, 200), (101, 200), (102, 201), (104, 204), (106, 206)]):
        rest = [f"own{n}x{k}" for k in range(300 - shared)]
        rows += [
            (100 + 2 * n + i, " ".join([*rest, *passage[: count + 4]])) for i, count in enumerate((shared, longer))
        ]
    settings = near_duplicates.Settings(sampled=1)
    found = near_duplicates.near_duplicates(table(spark, rows), settings=settings).collect()
    expected = components_by_hand(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert all(expected[101 + 2 * n] == 100 + 2 * n for n in range(6))


def test_families_of_frequent_shingles_equal_brute_force(spark):
    """Many variants of one text around the threshold, in blocks of a few."""
    draw = random.Random(8)
    base, rows = [f"b{k}" for k in range(90)], []
    for n in range(160):
        words = list(base)
        for _ in range(draw.randint(0, 5)):
            words[draw.randrange(90)] = f"own{n}x{draw.randrange(10**6)}"
        rows.append((1000 - n, " ".join(words)))
    settings = near_duplicates.Settings(sampled=1, frequent=20, block=30)
    found = near_duplicates.near_duplicates(table(spark, rows), settings=settings).collect()
    expected = components_by_hand(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert 1 < len(set(expected.values())) < 160


def test_frequent_shingles_are_counted_over_all_documents(spark):
    """Exactly the shingles that enough distinct sets hold, however many copies a set has."""
    passages = {held: [f"held{held}w{k}" for k in range(12)] for held in (1, 5, 6, 7, 40)}
    texts = [
        " ".join([*words, *(f"own{held}x{n}y{k}" for k in range(6))])
        for held, words in passages.items()
        for n in range(held)
    ]
    texts += [" ".join(f"copied{k}" for k in range(9))] * 50 + ["", None, "held6w0 held6w1"]
    texts = [(n, t) for n, t in enumerate(texts)]
    settings = near_duplicates.Settings(frequent=2, sampled=3)
    rows = spark.createDataFrame(texts, "id long, text string").repartition(5)
    held = [" ".join(passages[n]) for n in (6, 7, 40)]
    expected = np.sort(np.concatenate(near_duplicates.shingle_sets(pa.array(held), 5)))
    assert near_duplicates.frequent_shingles(rows, settings).tolist() == expected.tolist()


def test_every_linked_pair_of_shares_has_bands_in_common():
    """Bands of rare shingles or of whole sets, at a similarity of 0.75 and all shares of frequent ones."""
    settings = near_duplicates.Settings()
    for a, b, size in itertools.product(range(101), range(101), range(75, 134)):
        a_, b_, size_ = a / 100, b / 100, size / 100
        least = 3 / 7 * (1 + size_)
        frequent, rare = min(a_, b_ * size_), min(1 - a_, (1 - b_) * size_)
        if frequent + rare < least:
            continue
        common = least - frequent
        # no more than a fifteenth of the rare ones: bands of whole sets
        alike = max(0.0, common) / max(1e-9, 1 - a_ + (1 - b_) * size_ - common)
        if alike < 1 / 15 and min(a_, b_) >= settings.whole.least:
            alike, bands = 0.75, [settings.whole]
        else:
            bands = [x for x in settings.banding if x.least <= min(a_, b_) and max(a_, b_) <= x.most]
        missed = np.prod([(1 - alike**x.rows) ** x.bands for x in bands])
        assert missed < 2e-5, (a, b, size, alike)


def test_members_of_a_family_meet_only_in_its_comparison(spark, monkeypatch):
    """Variants of one passage whose rare rests have shingles in common, and one outsider."""
    passage, rows = " ".join(f"b{k}" for k in range(80)), []
    for n in range(40):
        # two of every three rests overlap by a rare shingle or more
        own = [f"own{n}x{k}" for k in range(12)] + [f"pair{n // 3}x{k}" for k in range(12)]
        rows.append((n + 1, f"{passage} {' '.join(own)}"))
    rows += [(100, rows[0][1] + " more"), (101, " ".join(f"pair0x{k}" for k in range(12)))]
    counted, across = {}, near_duplicates._across

    def count(*tables):
        found = across(*tables)
        counted["pairs"] = found.count()
        return found

    monkeypatch.setattr(near_duplicates, "_across", count)
    settings = near_duplicates.Settings(sampled=1, frequent=20)
    found = near_duplicates.near_duplicates(table(spark, rows), settings=settings).collect()
    expected = components_by_hand(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert expected[100] == 1 and len(set(expected.values())) > 20
    assert counted["pairs"] == 0


def test_components_meet_in_a_bucket_unless_in_one_family(spark):
    """Family numbers may equal those of components, and a component may lie in two families."""
    nodes = {1: (1, 1), 2: (2, 1), 3: (3, None), 4: (1, None), 5: (5, 2), 6: (2, 2)}
    buckets = spark.createDataFrame([(7, n, 1) for n in nodes] + [(8, 1, 1), (8, 2, 1)], "key long, node long, head long")
    roots = spark.createDataFrame([(n, r) for n, (r, _) in nodes.items() if n != r], "u long, v long")
    families = spark.createDataFrame([(n, f) for n, (_, f) in nodes.items() if f], "node long, family long")
    tried = spark.createDataFrame([(1, 3)], "a long, b long")
    found = near_duplicates._across(buckets, roots, families, tried).collect()
    expected = {
        (a, b)
        for a, b in itertools.combinations(nodes, 2)
        if nodes[a][0] != nodes[b][0] and (nodes[a][1] is None or nodes[a][1] != nodes[b][1])
    } - {(1, 3)}
    assert sorted((r["a"], r["b"]) for r in found) == sorted(expected)
