"""Top-k search, WARC records and chat formatting against brute force and round trips."""

import base64
import gzip
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saldero.llm import chat_format, topk_search, warc
from saldero.session import scratch_path

# Top-k search


def best_by_hand(rows, k):
    usable = []
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(256 * float(x))) for x in v]))
    found = set()
    for q, x in usable:
        if q % 50:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y)), c) for c, y in usable if c != q and len(y) == len(x)]
        found |= {(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k], 1)}
    return found


def vectors():
    draw = random.Random(11)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(24)]) for i in range(300)]
    rows += [(i, [0.5] * 24) for i in range(300, 330)]
    rows += [(350, None), (351, []), (352, [1.0, None] + [0.0] * 22), (353, [float("nan")] * 24)]
    rows += [(400, [float("inf")] * 24), (None, [1.0] * 24), (450, [1.0, 2.0]), (451, [2.0, 1.0])]
    return rows + [(500, [3e4] + [0.0] * 23), (501, [1e7] + [0.0] * 23), rows[3]]


@pytest.mark.parametrize("shape", [{}, {"block": 3, "chunk": 16}])
def test_top_k_equals_brute_force(spark, shape):
    rows = vectors()
    df = spark.createDataFrame(
        [(i, v, 1, "s") for i, v in rows], "vec_id long, embedding array<double>, rank int, id string"
    )
    found = topk_search.top_k(df, F.col("vec_id") % 50 == 0, **shape).collect()
    # the candidate that is there twice counts twice
    assert len(found) == len(best_by_hand(rows, 5))
    assert {tuple(r) for r in found} == best_by_hand(rows, 5)


def test_fewer_candidates_than_k_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert topk_search.top_k(df, F.col("vec_id") % 50 == 0).collect() == [(0, 1, 1, 256 * 512)]
    assert topk_search.top_k(df.where("false"), F.lit(True)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 20), st.integers(0, 10**6))
def test_bounds_hold_at_every_resolution(size, seed):
    draw = np.random.default_rng(seed)
    x, y = draw.normal(size=(5, size)), draw.normal(size=(7, size))
    for segments in (1, 2, 4, 16):
        bound = topk_search.features(x, segments) @ topk_search.features(y, segments).T
        assert (bound >= x @ y.T - 1e-9).all()


# WARC

PAGES = [
    (1, "http://a/é b\r\nx", "same"), (4, None, "same"), (2, "u", None), (3, "u", ""),
    (5, "u", "long " * 5000), (6, "u", "ünï" * 9000), (7, "u", "long " * 5000),
    (None, "u", "same"), (None, "u", "alone"), (8, "u", "twice"), (8, "u", "twice"),
    (9, "u", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1"),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 0) for r in rows], "page_id long, url string, html string, digest string, number int")


def expected_pages(rows, least=0):
    by_text = {}
    for i, _, text in rows:
        by_text.setdefault(text or "", []).append(i)
    found = []
    for i, _, text in rows:
        data = (text or "").encode()
        owner = min((x for x in by_text[text or ""] if x is not None), default=None)
        again = len(data) >= least and i != owner
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        found.append((i, len(data), digest, "revisit" if again else "response", owner if again else None))
    return sorted(found, key=str)


@pytest.mark.parametrize("least", [0, 10])
def test_archives_are_read_back(spark, least):
    path = f"{scratch_path(spark, 'warc')}/a"
    warc.write_archives(
        pages(spark, PAGES), path, min_revisit_bytes=least, segment_bytes=1000, chunk_bytes=100
    )
    found = warc.read_archives(spark, path)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.select(columns).collect()), key=str) == expected_pages(PAGES, least)
    kept = {r["page_id"]: bytes(r["payload"]).decode() for r in found.collect() if r["payload"] is not None}
    assert kept[5] == "long " * 5000 and kept[6] == "ünï" * 9000


def test_archives_of_no_pages(spark):
    path = f"{scratch_path(spark, 'warc')}/a"
    warc.write_archives(pages(spark, []), path)
    assert warc.read_archives(spark, path).count() == 0


def segments(payload=b"x" * 500):
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    blobs = list(warc.records(1, "u", payload, digest, None, "0-1", 200, 64))
    found = [next(warc.parse(b + b"\r\n\r\n")) for b in blobs]
    parts = [
        {
            "number": int(h["warc-segment-number"]),
            "total": int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None,
            "block": block,
        }
        for h, block in found
    ]
    return digest, parts, found


def test_segments_come_in_any_order_and_may_repeat():
    digest, parts, found = segments()
    assert len(parts) > 2
    assert {h["warc-type"] for h, _ in found[1:]} == {"continuation"}
    assert len({h["warc-segment-origin-id"] for h, _ in found[1:]} | {found[0][0]["warc-record-id"]}) == 1
    assert warc.reassemble("r", digest, [*parts[::-1], parts[0]]) == b"x" * 500


def test_damaged_segments_are_refused():
    digest, parts, _ = segments()
    with pytest.raises(warc.WarcError, match="lacks a segment"):
        warc.reassemble("r", digest, [parts[0], *parts[2:]])
    with pytest.raises(warc.WarcError, match="bytes, not"):
        warc.reassemble("r", digest, parts[:-1] + [parts[-1] | {"total": 7}])
    with pytest.raises(warc.WarcError, match="digest"):
        warc.reassemble("r", "A" * 32, parts)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunked_framing_round_trip(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload


def test_framing_with_extensions_and_breaks():
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: t\r\n\r\n") == b"abc"
    for broken in (b"5\r\nabc", b"3\r\nabcd\r\n0\r\n\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(warc.WarcError):
            warc.unchunked(broken)


def test_plain_and_packed_files_parse_alike():
    record = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert list(warc.parse(record * 2)) == list(warc.parse(gzip.compress(record * 2)))
    with pytest.raises(warc.WarcError):
        list(warc.parse(record[:-6]))


# Chat formatting

TEMPLATE = chat_format.MarkedTemplate()
said = st.text("ab\\#<>/:\n turn</turn>### user: ", max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(said, said), max_size=12), st.integers(1, 5))
def test_every_turn_is_read_back_from_its_span(turns, block):
    text, spans, rewriting = chat_format.locate(TEMPLATE, turns, block)
    assert text == TEMPLATE(turns) and not rewriting
    assert [TEMPLATE.read(text[s.start : s.end]) for s in spans] == turns
    assert [TEMPLATE.unescape(text[s.text_start : s.text_end]) for s in spans] == [t for _, t in turns]


def test_templates_that_rewrite_history_are_detected():
    def only_last_has_thoughts(turns):
        return "".join(
            f"<{r}>{t if n == len(turns) - 1 else t.split('|')[-1]}" for n, (r, t) in enumerate(turns)
        )

    turns = [("u", "a"), ("a", "hm|b"), ("u", "c"), ("a", "d")]
    _, _, rewriting = chat_format.locate(only_last_has_thoughts, turns)
    assert rewriting == [2]
    assert chat_format.locate(only_last_has_thoughts, turns[:2])[2] == []


def test_every_turn_is_rendered_after_all_turns_before_it():
    def counted(turns):
        # every turn names its number, the first turn and, at turn 150, the first is rewritten
        first = turns[0][1].upper() if len(turns) == 150 else turns[0][1]
        return f"<{first}>" + "".join(f"[{n} {first} {r}]{t};" for n, (r, t) in enumerate(turns))

    turns = [("u" if n % 2 else "a", f"turn {n}") for n in range(200)]
    text, spans, rewriting = chat_format.locate(counted, turns)
    assert text == counted(turns)
    assert rewriting == [149, 150]
    assert [text[s.text_start : s.text_end] for s in spans[151:]] == [t for _, t in turns[151:]]

    def long_ago(turns):
        return "".join(f"<{r}>{t if n > len(turns) - 101 else t[0]}" for n, (r, t) in enumerate(turns))

    text, _, rewriting = chat_format.locate(long_ago, turns)
    assert text == long_ago(turns) and rewriting == list(range(100, 200))


def test_conversations_and_their_loss_text(spark):
    control = "\\### Assistant: </turn> ok"
    rows = [
        (1, 1, "assistant", control), (1, 0, "user", control), (2, None, "system", None), (2, 0, None, ""),
        (None, 0, "user", "n"), (3, 5, "assistant", "t"), (3, 5, "assistant", "s"), (3, 5, "assistant", "s"),
    ]
    rows += [(4, n, "assistant" if n % 2 else "user", f"turn {n}") for n in range(300)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, spans int")
    formatted = chat_format.format_conversations(df, TEMPLATE)
    found = {r["conv_id"]: r for r in chat_format.read_back(formatted, TEMPLATE).collect()}
    assert found[1]["turns"] == f"user\n{control}\nassistant\n{control}\n"
    assert found[1]["loss"] == control
    assert (found[2]["n_turns"], found[2]["turns"]) == (2, "system\n\n\n\n")
    assert found[3]["loss"] == "sst" and found[None]["turns"] == "user\nn\n"
    assert found[4]["loss"] == "".join(f"turn {n}" for n in range(1, 300, 2))
    assert found[4]["formatted_chars"] == len(TEMPLATE([(r[2], r[3]) for r in rows[8:]]))
    assert chat_format.format_conversations(df.where("false"), TEMPLATE).count() == 0
