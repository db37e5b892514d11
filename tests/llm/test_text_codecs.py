"""Chat formatting, token counts, byte-level BPE and GIF columns against libraries, fixtures and round trips."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from malgeul.llm import byte_bpe, chat, gif, queries, token_count

ODD = [
    None, "", " ", "a", "Hello  world\n\n", "it's we'RE don't 's", "İstanbul ΣΑΣ Σ", "é é", "\x1c\x1d a\x85b\xa0c d　", "naïve ###$$$ 12345 ½ ٣",
    "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "한국어 텍스트 😀😀 👩‍👩‍👧", "a" * 3000, "ab" * 2500 + " end", "\t\r\n\x0b\x0c  \t", "x\x00y", "Ａｂｃ ﬁ ǅ", "ͅẞ ß",
]
DOC = "doc_id long, text string"


def frame(spark, texts, extra=False):
    if extra:
        return spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(texts)], DOC + ", row int, n_tokens string")
    return spark.createDataFrame(list(enumerate(texts)), DOC)


def test_byte_bpe_equals_tiktoken(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = queries.byte_codec()
    got = {r["doc_id"]: r for r in byte_bpe.round_trip(frame(spark, ODD, True), codec).collect()}
    for i, t in enumerate(ODD):
        ids = lib.encode_ordinary(t or "")
        assert codec.encode(t or "") == ids, repr(t)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(frame(spark, ODD), codec), codec).collect()
    assert {r["doc_id"]: bytes(r["data"]) for r in back} == {i: (t or "").encode() for i, t in enumerate(ODD)}
    odd = spark.createDataFrame([(1, None), (2, []), (3, [10**6]), (4, [None]), (5, codec.encode("ok"))], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["data"] and bytes(r["data"]) for r in byte_bpe.decode(odd, codec).collect()} == {1: b"", 2: b"", 3: None, 4: None, 5: b"ok"}
    assert byte_bpe.encode(frame(spark, []), codec).count() == 0
    twice = spark.createDataFrame([(1, "b a"), (1, "b a"), (None, "b a")], DOC)
    assert byte_bpe.round_trip(twice, codec).count() == 3


def test_byte_bpe_cache(monkeypatch):
    """Rare pre-tokens do not drive out a common one, the cache stays bounded, and equal ids are one number in what it keeps."""
    monkeypatch.setattr(byte_bpe, "CACHE", 8)
    ranks = {bytes([b]): b for b in range(256)} | {b"qq": 300, b"qqq": 301}
    codec, asked = byte_bpe.Codec(ranks, P.PATTERN), []
    get = codec.index.get
    codec.index.get = lambda key: (asked.append(key), get(key))[1]
    for i in range(40):
        assert codec.decode(codec.encode(f"zqq r{i} zqq")) == f"zqq r{i} zqq".encode()
        assert len(codec.cache) + len(codec.before) <= 8
    assert asked.count(b"zqq") == 1
    kept = [ids for ids in (*codec.cache.values(), *codec.before.values()) if 300 in ids]
    assert kept and len({id(i) for ids in kept for i in ids if i == 300}) == 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abé' \n\t1½-"), max_size=40))
def test_byte_bpe_random(text):
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=_ranks(), special_tokens={})
    assert queries.byte_codec().encode(text) == lib.encode_ordinary(text)


_cache = {}


def _ranks():
    if not _cache:
        _cache.update(byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))
    return _cache


def test_perfect_hash():
    ranks = _ranks()
    index = byte_bpe.PerfectHash(ranks)
    assert len(index.keys) == len(ranks) and all(index.get(k) == v for k, v in ranks.items())
    assert index.get(b"no such entry at all") == -1 and byte_bpe.PerfectHash({}).get(b"a") == -1


def test_merges_follow_rank_then_place():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ab": 258, b"bc": 300, b"abc": 301}
    for text in (b"aaaa", b"aaaaa", b"abc", b"aabc", b"bcabcab"):
        parts = [text[i : i + 1] for i in range(len(text))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        codec = byte_bpe.Codec(ranks, P.PATTERN)
        assert byte_bpe.merge_bytes(list(text), codec.pairs) == [ranks[p] for p in parts]


def test_token_counts_equal_library(spark, monkeypatch):
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tokenizer = queries._word_tokenizer()
    real = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    want = sorted((i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(ODD + real))
    for hot in (token_count.HOT, 300, 0):  # few or no pre-tokens are broadcast: the others are joined
        monkeypatch.setattr(token_count, "HOT", hot)
        got = token_count.count_tokens(frame(spark, ODD + real, True), tokenizer).collect()
        assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    twice = spark.createDataFrame([(1, "b a"), (1, "b a"), (None, "b"), (None, None)], DOC)
    got = token_count.count_tokens(twice, tokenizer).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, 0), (0, 1), (1, 2), (1, 2)]
    assert token_count.count_tokens(frame(spark, []), tokenizer).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.integers(0, 3))
def test_lzw_round_trip(data, kind):
    data = [data, bytes(b & 3 for b in data), data[:7] * 900, b"\0" * 9000][kind]
    assert gif.lzw_decode(gif.lzw_encode(data, 8), 8, len(data)) == data
    small = bytes(b & 3 for b in data)
    assert gif.lzw_decode(gif.lzw_encode(small, 2), 2, len(small)) == small


def test_lzw_known_stream():
    # the 10 x 10 sample picture of the public description of the format
    stream = bytes.fromhex("8C2D99872A1CDC33A00275EC95FAA8DE608C0491 4C01".replace(" ", ""))
    want = "1111122222 1111122222 1111122222 1110000222 1110000222 2220000111 2220000111 2222211111 2222211111 2222211111".replace(" ", "")
    assert "".join(map(str, gif.lzw_decode(stream, 2, 100))) == want


def plain_gif(data):
    """The samples of a GIF without disposal or transparency: bits one by one, strings in a list."""
    at, out, local = 13, bytearray(), b""
    shared = data[13 : 13 + 3 * (2 << (data[10] & 7))] if data[10] & 0x80 else b""
    at += len(shared)
    while data[at] != 0x3B:
        if data[at] == 0x21:
            at += 2
        else:
            width, height, flags = data[at + 5] | data[at + 6] << 8, data[at + 7] | data[at + 8] << 8, data[at + 9]
            at += 10
            local = data[at : at + 3 * (2 << (flags & 7))] if flags & 0x80 else b""
            at += len(local)
            bits, stream, pos = data[at], bytearray(), at + 1
            while data[pos]:
                stream += data[pos + 1 : pos + 1 + data[pos]]
                pos += 1 + data[pos]
            number, place, strings, size, last, made = int.from_bytes(stream, "little"), 0, [], bits + 1, None, bytearray()
            while True:
                code = number >> place & ((1 << size) - 1)
                place += size
                if code == 1 << bits:
                    strings, size, last = [bytes([i]) for i in range(1 << bits)] + [b"", b""], bits + 1, None
                    continue
                if code == (1 << bits) + 1:
                    break
                now = strings[code] if code < len(strings) else last + last[:1]
                if last is not None and len(strings) < 4096:
                    strings.append(last + now[:1])
                    size = min(12, max(size, len(strings).bit_length()))
                made += now
                last = now
            assert len(made) == width * height
            table = local or shared
            out += bytes(table[3 * i] for i in made)
            at += 1
        while data[at]:
            at += 1 + data[at]
        at += 1
    return bytes(out)


def test_gif_against_plain_decoder():
    rng = np.random.default_rng(3)
    for payload in (bytes(range(256)) * 8, rng.integers(0, 256, 64 * 200, np.uint8).tobytes(), b"ab" * 6400, b"\0" * 64):
        assert plain_gif(gif.store(payload)) == payload


def test_gif_read_back_of_odd_media(spark):
    good = gif.store(b"x" * 64)
    rows = spark.createDataFrame([(1, 1, bytearray(good)), (2, 1, None), (3, 1, bytearray(b"")), (4, 1, bytearray(good[:-9])), (None, None, bytearray(b"GIF89a"))], "doc_id long, n_bytes long, media binary")
    got = {r["doc_id"]: r for r in gif.read_back(rows).collect()}
    assert got[1]["payload_bytes"] == 64 and got[2]["media_bytes"] is None and got[4]["media_bytes"] == len(good) - 9
    assert all(got[i]["payload_sha256"] is None and got[i]["feature"].startswith("error=") for i in (2, 3, 4, None))


def test_gif_rules(spark):
    red, pal = 1, np.array([[0, 0, 0], [255, 0, 0], [0, 255, 0], [0, 0, 255]], np.uint8)
    full = np.full((2, 3), red, np.uint8)
    dot = np.array([[2, 0]], np.uint8)
    own = np.array([[9, 9, 9], [250, 250, 250]], np.uint8)
    movie = gif.Gif(3, 2, 0, pal, [
        gif.Frame(0, 0, full, pal, delay_cs=5),
        gif.Frame(1, 1, dot, pal, transparent=0, disposal=3, delay_cs=7),
        gif.Frame(0, 0, np.array([[1]], np.uint8), own, disposal=2, delay_cs=1),
        gif.Frame(2, 0, np.array([[3]], np.uint8), pal),
    ])
    data = gif.write_gif(movie)
    shown = list(gif.compose(gif.read_gif(data)))
    assert [(a, d) for a, d, _ in shown] == [(0, 5), (5, 7), (12, 1), (13, 0)]
    assert shown[1][2][1].tolist() == [[255, 0, 0, 255], [0, 255, 0, 255], [255, 0, 0, 255]]
    assert shown[2][2][1].tolist() == [[255, 0, 0, 255]] * 3 and shown[2][2][0, 0].tolist() == [250, 250, 250, 255]
    assert shown[3][2][0].tolist() == [[0, 0, 0, 0], [255, 0, 0, 255], [0, 0, 255, 255]]
    rows = spark.createDataFrame([(1, bytearray(data)), (1, bytearray(data)), (2, None), (3, bytearray(b"GIF89a")), (4, bytearray(data[:60]))], "doc_id long, media binary")
    got = gif.decode_frames(rows, "doc_id", "media").collect()
    assert sum(r["doc_id"] == 1 for r in got) == 8
    assert all(r["error"] and r["rgba"] is None for r in got if r["doc_id"] > 1) and sum(r["doc_id"] > 1 for r in got) == 3
    first = next(r for r in got if r["frame"] == 1)
    assert (first["start_ms"], first["duration_ms"], first["width"], first["height"], sum(first["histogram"])) == (50, 70, 3, 2, 6)


def test_gif_interlaced():
    pal = np.arange(48, dtype=np.uint8).reshape(16, 3)
    pixels = np.repeat(np.arange(10, dtype=np.uint8)[:, None], 4, axis=1)
    data = bytearray(gif.write_gif(gif.Gif(4, 10, 0, pal, [gif.Frame(0, 0, pixels, pal)])))
    at = data.index(b"\x2c", 13 + 48 + 8)
    data[at + 9] |= 0x40
    rows = gif.read_gif(bytes(data)).frames[0].pixels[:, 0].tolist()
    assert rows == [0, 5, 3, 6, 2, 7, 4, 8, 1, 9]


def test_gif_payloads(spark, monkeypatch):
    texts = [*ODD, "x" * 64, "x" * 65, "é" * 100_000]
    for side in (gif.MAX_SIDE, 7):
        monkeypatch.setattr(gif, "MAX_SIDE", side)
        for t in texts:
            raw = (t or "").encode()
            raw = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
            assert gif.payload_of(gif.read_gif(gif.store(raw)))[0] == raw
            if len(raw) > 50_000 and side == 7:
                break
    monkeypatch.undo()
    got = {r["doc_id"]: r for r in gif.read_back(gif.encode_texts(frame(spark, texts, True))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        full = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert (got[i]["n_bytes"], got[i]["payload_bytes"]) == (len(raw), len(full))
        assert got[i]["payload_sha256"] == hashlib.sha256(full).hexdigest()
    assert gif.read_back(gif.encode_texts(frame(spark, []))).count() == 0


def test_chat_format(spark):
    turns = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b<next/>"), (1, 2, "assistant", "c\\"), (1, 3, "user", "</turn>\n### x</role>"), (1, 3, "user", None),
        (2, 0, None, None), (None, 5, "assistant", "z"), (3, None, "assistant", "###"), (3, 1, "assistant", "###"), (3, 1, "assistant", "###"), (4, 0, "as#<\\", "\\\\<#" * 50),
    ]
    df = spark.createDataFrame([(*t, 1, "q") for t in turns], "conv_id long, turn long, role string, text string, place int, pieces string")
    chats = chat.format_conversations(df)
    own = {r["conv_id"]: r for r in chats.collect()}
    assert own[1]["formatted"].startswith("### user</role>\na</turn>\n### assistant</role>\nb<\\next/><next/>c\\\\</turn>\n")
    assert own[1]["formatted"].count("### ") == 3
    for r in chat.digests(chats).collect():
        rows = sorted((t for t in turns if t[0] == r["conv_id"]), key=lambda t: (-1 if t[1] is None else t[1], t[2] or "", t[3] or ""))
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in rows)
        loss = "".join(t[3] or "" for t in rows if t[2] == "assistant")
        assert r["n_turns"] == len(rows)
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == len(own[r["conv_id"]]["formatted"])
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0
    long = spark.range(500).selectExpr("7 AS conv_id", "id AS turn", "CASE WHEN id % 5 < 2 THEN 'user' ELSE 'assistant' END AS role", "concat('<', id) AS text")
    one = chat.format_conversations(long).first()
    assert "".join(one["formatted"][a:b] for a, b in one["loss_spans"]) == "".join(f"<\\{i}" for i in range(500) if i % 5 > 1) and one["formatted"].count("### ") == 200
    plan = queries.op4_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Window", "ExistingRDD"))
