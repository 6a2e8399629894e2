"""Byte-level BPE, token counts and secrets against the libraries and plain searches."""

from __future__ import annotations

import base64
import hashlib
import random
import struct
import tracemalloc
from itertools import accumulate

import pytest

from topicpulse.llm import bpe, secrets, token_counts, unit_table

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")

PIECES = [
    "a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "​", "'s", "'", "é",
    "1", "٣", "漢", "😀", "<|endoftext|>", "<|endof", "!", "the", "ing", "aaaa", "Ⅷ", "\x00", "\r",
]
EDGES = [None, "", " ", "a", "same same", "same same", "x" * 5000, " " * 3000, "ab " * 30000]


def texts():
    draw = random.Random(7)
    odd = ["".join(draw.choices(PIECES, k=draw.randint(0, 30))) for _ in range(2000)]
    return EDGES + odd


@pytest.fixture(scope="module")
def library():
    with open(vocabularies.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_ids_are_those_of_the_library(table, library):
    rows = list(enumerate(texts()))
    found = {r.doc_id: r for r in bpe.round_trip(table(rows)).collect()}
    assert len(found) == len(rows)
    for n, text in rows:
        ids = library.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert found[n].n_tokens == len(ids), text
        assert found[n].ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert found[n].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_encode_and_decode_of_a_frame(table, library):
    rows = list(enumerate(texts()[:600]))
    found = {r.doc_id: r for r in bpe.decode(bpe.encode(table(rows))).collect()}
    for n, text in rows:
        ids = library.encode_ordinary(text or "")
        assert bytes(found[n].ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert bytes(found[n].decoded) == (text or "").encode()


def test_many_buckets_and_small_gatherings_change_nothing(table, monkeypatch):
    rows = list(enumerate(texts()[:700]))
    expected = sorted(bpe.round_trip(table(rows)).collect())
    monkeypatch.setattr(unit_table, "UNITS_HELD", 20)
    monkeypatch.setattr(unit_table, "UNITS_ENCODED", 3)
    monkeypatch.setattr(unit_table, "BUCKET_BYTES", 3000)
    assert sorted(bpe.round_trip(table(rows).repartition(3)).collect()) == expected
    assert bpe.round_trip(table([])).count() == 0


def test_few_texts_are_sent_to_a_worker_at_a_time(spark, table, monkeypatch):
    """A buffer of the texts a worker gets holds about ``SENT`` bytes, however many rows there are."""
    mapped = bpe.map_rows

    def watched(frame, make, *rest):
        def make_watched():
            apply = make()

            def look(batch):
                assert batch.column(1).buffers()[2].size < 16 << 20
                return apply(batch)

            return look

        return mapped(frame, make_watched, *rest)

    monkeypatch.setattr(bpe, "map_rows", watched)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    many = table([(0, "same words " * 10_000)]).crossJoin(spark.range(0, 400, 1, 1))
    assert bpe.round_trip(many).distinct().count() == 1
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_replay_goes_back_to_lower_ranks(library):
    """Merges that make a pair of a lower rank than their own."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256 + 9, b"abc": 256 + 1, b"abcd": 256}
    own = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    words = ["abcd", "abcabc", "bcbc", "aabcd", "abcdabcd", "bca"]
    coded = bpe.MergeReplay(ranks).encode([w.encode() for w in words])
    assert coded == [own.encode_ordinary(w) for w in words]


def test_a_small_memo_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    monkeypatch.setattr(bpe, "PART_CHARS", 50)
    with open(vocabularies.path("byte_bpe_50k.tiktoken"), "rb") as file:
        encoder = bpe.TextEncoder(bpe.read_ranks(file.read()), vocabularies.PATTERN)
    for text in texts()[:400]:
        ids = library.encode_ordinary(text or "")
        assert encoder.encode([text]) == [struct.pack(f"<{len(ids)}I", *ids)]


def test_counts_are_those_of_the_library(table):
    library = tokenizers.Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json"))
    rows = list(enumerate(texts()))
    for size, overlap in ((token_counts.CHUNK_CHARS, 256), (40, 4)):
        counted = token_counts.count_tokens(table(rows), chunk_chars=size, overlap_chars=overlap)
        found = {r.doc_id: r for r in counted.collect()}
        assert len(found) == len(rows)
        for n, text in rows:
            expected = len(library.encode(text or "", add_special_tokens=False))
            assert found[n].n_tokens == expected, (size, text)
            assert found[n].n_bytes == len((text or "").encode())
            assert found[n].over_limit == (expected > 1024)


def test_repeated_rows_and_empty_tables(table):
    for run in (bpe.round_trip, token_counts.count_tokens, secrets.secret_counts):
        assert run(table([])).count() == 0
        assert run(table([(1, "a b"), (1, "a b"), (None, "a b")])).count() == 3


def searched(text):
    found = []
    for rank, kind in enumerate(secrets.BASE_KINDS):
        for m in secrets.PATTERNS[kind].finditer(text or ""):
            size = len(m.group(2)) if kind == "assign" else m.end() - m.start()
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), rank, m.end()))
    return [(secrets.BASE_KINDS[k], s, e) for s, k, e in sorted(found)]


def signed(prefix, body):
    import zlib

    crc, digits = zlib.crc32(body.encode()), ""
    while crc:
        crc, d = divmod(crc, 62)
        digits = secrets.BASE62[d] + digits
    return prefix + body + digits.rjust(6, "0")


def test_secrets_are_those_of_plain_searches(table):
    draw = random.Random(3)
    parts = ["password", "Token", "SECRET", "api_key", "apiKey", "passwd", ":", "=", "'", '"', " ",
             "abc", "deadbeef", "0123456789abcdef", "AKIA", "ABCDEFGH1234", "İ", "K", "x", "_",
             "ſecret", "é", "a" * 26]
    rows = [(n, "".join(draw.choices(parts, k=draw.randint(0, 14)))) for n in range(3000)]
    rows += [(3000 + n, t) for n, t in enumerate(EDGES)]
    found = {r.doc_id: r for r in secrets.secret_counts(table(rows)).collect()}
    for n, text in rows:
        spans = searched(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert found[n].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text
        counts = [found[n].n_assign, found[n].n_access, found[n].n_hex]
        assert counts == [sum(k == b for k, _, _ in spans) for b in secrets.BASE_KINDS]


def test_checksums_decide_on_spans_of_their_own(table):
    good = signed("ghp_", "k7" * 15)
    rows = [(0, f"x {good} y"), (1, f"x {good[:-1]}{'1' if good[-1] != '1' else '2'} y"),
            (2, signed("npm_", "Zq" * 15)), (3, "nsec1vl029mgpspedva04g90vltkh6fvh240zqtv9k0t9af8935ke9laqsnlfe5")]
    spans = {r.doc_id: r.spans for r in secrets.secret_counts(table(rows)).collect()}
    assert spans == {0: "github:2:42", 1: "", 2: "npm:0:40", 3: "nostr:0:63"}


def test_a_task_deals_out_few_units_at_a_time():
    units = {f" unit number {n:015}" for n in range(unit_table.UNITS_HELD)}
    tracemalloc.start()
    try:
        dealt = unit_table._dealt(units, 40)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 64 << 20
    got = {
        data[end - length : end].decode()
        for lengths, data in zip(dealt.column("lengths").to_pylist(), dealt.column("data").to_pylist())
        for length, end in zip(lengths, accumulate(lengths))
    }
    assert got == units
    assert dealt.column("bucket").to_pylist() == list(range(40))
