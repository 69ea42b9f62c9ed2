"""The corpus operators against libraries, brute force and exact round trips, and on awkward rows."""

import collections
import gzip
import hashlib
import io
import itertools
import os
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from posada.llm import (byte_bpe, chunks, components, forest, itq, licenses, packing, probminhash, queries, scan, token_counts,
                        toxicity, warc)
from posada.llm.common import stage, utf8

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = list("aseltrvdm'' \n\t1é２x.!中🎉") + ["　", "\x1c", "'re", "'ll", " '", "İΣ", "<|endoftext|>"]
AWKWARD = [None, "", "  ", "a", "The same text again and again.", "The same text again and again.", "x" * 70_000,
           "words of a long text " * 3_000, "<|endoftext|> inside", "é" * 9]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i if i != 3 else None, t, None, "s", None) for i, t in enumerate(AWKWARD)], SCHEMA)


def words(n, seed, alphabet="abcdefgh"):
    draw = random.Random(seed)
    return ["".join(draw.choices(alphabet, k=draw.randint(2, 9))) for _ in range(n)]


# --- pre-tokens and byte-level BPE --------------------------------------------------------------------------------

@pytest.mark.parametrize("spaced, pattern", [
    (True, public_tokenizers.PATTERN), (False, r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")])
def test_splitter_equals_the_pattern(spaced, pattern):
    draw = random.Random(3)
    texts = ["".join(draw.choices(ALPHABET, k=draw.randint(0, 14))) for _ in range(5000)] + ["a b" * 500]
    data, ends = utf8(pa.array(texts))
    starts, stops, first = scan.splitter(spaced).split(data, ends)
    held, wanted = data.tobytes(), regex.compile(pattern)
    found = [held[a:b].decode() for a, b in zip(starts.tolist(), stops.tolist())]
    for i, text in enumerate(texts):
        assert found[first[i]:first[i + 1]] == wanted.findall(text), repr(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_bpe_equals_the_library_and_decodes(texts):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    for text, (ids, ends) in zip(texts, byte_bpe.encode_texts(pa.array(texts), RANKS)):
        assert ids == library.encode_ordinary(text)
        assert byte_bpe.decode_ids(ids, RANKS) == text.encode() and (not ends or ends[-1] == len(ids))


def test_long_slices_merge_like_short_ones():
    ranks = byte_bpe.load_ranks(RANKS)
    for text in ("a" * 3000, "abab" * 300, "héllo" * 200, "_" * 333):
        assert byte_bpe.merge_long(text.encode(), ranks) == byte_bpe.merge_short(text.encode(), ranks)


def test_encode_decode_on_spark(awkward):
    clashing = awkward.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    rows = byte_bpe.decode(byte_bpe.encode(clashing, RANKS), RANKS).collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    assert byte_bpe.encode(awkward.limit(0), RANKS).count() == 0


def test_token_counts_equal_the_library(spark, awkward):
    library = Tokenizer.from_file(BYTE_JSON)
    rows = token_counts.token_counts(awkward.withColumn("n_tokens", F.lit("clash")), BYTE_JSON, limit=10).collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        n = len(library.encode(row["text"] or "", add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len((row["text"] or "").encode()), n, n > 10)
    assert token_counts.token_counts(awkward.limit(0), BYTE_JSON).count() == 0


# --- packing ------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_plan_holds_every_piece_and_is_tight(seed):
    draw = np.random.default_rng(seed)
    counts = np.bincount(draw.integers(1, 201, 3000), minlength=201)
    planned = packing.plan(counts, 200)
    held = np.zeros(201, np.int64)
    for column, times in planned:
        assert sum(k * n for k, n in column.items()) <= 200 and times > 0
        for k, n in column.items():
            held[k] += n * times
    assert (held == counts).all()
    assert sum(t for _, t in planned) <= 1.01 * -(-(counts * np.arange(201)).sum() // 200) + 1


def test_plan_beats_plain_filling_on_hot_lengths():
    """Plain filling pairs 2089 with 1106 and needs 110,000 sequences; 2089 + 1065 + 942 and 2 x 1106 + 2 x 942 are full."""
    draw = np.random.default_rng(7)
    counts = np.bincount(np.clip(draw.lognormal(4, .6, 1000).astype(int), 1, 4096), minlength=4097)
    counts[[2089, 1106, 1065, 942]] += [60_000, 60_000, 60_000, 120_000]
    columns, left = packing.covering_plan(counts, 4096, packing.STEPS)
    assert left.sum() <= 0.01 * counts.sum()                      # plain filling gets the remainder of the rounding only
    planned, held = packing.plan(counts, 4096), np.zeros(4097, np.int64)
    for column, times in planned:
        assert sum(k * n for k, n in column.items()) <= 4096 and times > 0
        for k, n in column.items():
            held[k] += n * times
    assert (held == counts).all()
    assert sum(t for _, t in planned) <= 1.001 * -(-(counts * np.arange(4097)).sum() // 4096) + 1


def test_packing_on_spark(spark, awkward):
    library = Tokenizer.from_file(WORD_JSON)
    draw = random.Random(5)
    more = [(100 + i, "".join(draw.choices(ALPHABET + ["word ", "Two "], k=draw.randint(0, 60)))) for i in range(200)]
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    pieces = stage(spark).put(packing.token_pieces(docs, WORD_JSON, capacity=64), "pieces")
    rows = packing.pack(pieces, ["doc_id", "piece", "start", "ids"], capacity=64).collect()
    by_doc, by_sequence = collections.defaultdict(dict), collections.defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]][row["start"]] = row["ids"]
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
        assert row["length"] == len(row["ids"]) and row["start"] == 64 * row["piece"]
    for doc_id, text in [(i if i != 3 else None, t) for i, t in enumerate(AWKWARD)] + more:
        ids = [i for _, part in sorted(by_doc[doc_id].items()) for i in part]
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 64
    assert packing.pack(pieces.limit(0), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        packing.pack(pieces.withColumn("length", F.lit(65).cast("bigint")), ["doc_id"], capacity=64)


# --- licenses -----------------------------------------------------------------------------------------------------

def plain_scan(text):
    held = [w for w in regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))]
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(held))
              if held[i:i + len(phrase.split())] == phrase.split()]
    return len(held), sorted(places)


def test_base_places_equal_a_plain_scan():
    draw = random.Random(11)
    tokens = "gnu general public license apache cc by mit x licence É 9 -".split() + ["\n", ", "]
    for _ in range(400):
        text = " ".join(draw.choices(tokens, k=draw.randint(0, 40)))
        found, (n, places) = licenses.scan_text(text), plain_scan(text)
        assert found["n_words"] == n
        assert sorted((s[1], s[0]) for s in found["spans"] if s[3] == 0) == places


def test_near_notices_and_awkward_rows(awkward):
    found = licenses.scan_text("Apach License; GNU Generel Publik License, the MIT Licence. cc buy")
    assert (found["base_labels"], found["labels"]) == ("", "apache,gpl,mit") and 0 < found["score"] < 1
    rows = licenses.scan_licenses(awkward.withColumn("score", F.lit("clash"))).collect()
    assert len(rows) == len(AWKWARD) and all(r["labels"] == "" and r["score"] == 0 for r in rows)
    assert licenses.scan_licenses(awkward.limit(0)).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_places_equal_edit_distances_of_word_runs():
    for text, label in (("MIT licensed", "mit"), ("mit licenses.", "mit"), ("Apache Licenses", "apache"), ("xmit license", "mit"),
                        ("GNU general public licenses", "gpl"), ("the gnu general public licensed x", "gpl")):
        assert licenses.scan_text(text)["labels"] == label, text
    both = licenses.scan_text("mit licens mit license")
    assert sorted(s[1:4] for s in both["spans"]) == [(0, 2, 1), (2, 2, 0)]
    draw, letters = random.Random(12), "aegilnpstu "
    for _ in range(500):
        parts = []
        for _ in range(draw.randint(1, 4)):
            part = list(draw.choice([p for p, _ in licenses.PHRASES]))
            for _ in range(draw.choice([0, 1, 1, 2, 3])):
                at = draw.randrange(len(part))
                part[at:at + draw.choice([0, 1])] = draw.choice(["", *letters])
            parts.append("".join(part))
        text = draw.choice([" ", " x "]).join(parts)
        held, spans = text.split(), licenses.scan_text(text)["spans"]
        for phrase, label in licenses.PHRASES:
            k = licenses.errors_for(phrase)
            runs = {(i, j - i): n for i in range(len(held)) for j in range(i + 1, min(len(held), i + 9) + 1)
                    if (n := edits(" ".join(held[i:j]), phrase)) <= k}
            wanted = []
            for (i, size), n in sorted(runs.items(), key=lambda x: (x[1], x[0][0], -len(" ".join(held[x[0][0]:sum(x[0])])))):
                if n == 0 or not any(i < a + b and a < i + size for a, b, _ in wanted):
                    wanted.append((i, size, n))
            assert sorted(s[1:4] for s in spans if s[0] == label) == sorted(wanted), text


# --- toxicity -----------------------------------------------------------------------------------------------------

def test_toxicity_learns_and_scores(spark, awkward):
    vocabulary, bad = words(400, 1), ["zorgblat", "quxxor", "wibblef"]
    draw = random.Random(2)
    rows = []
    for i in range(400):
        text, toxic = draw.choices(vocabulary, k=60), i % 4 == 0
        if toxic:
            for _ in range(4):
                text.insert(draw.randrange(len(text)), draw.choice(bad))
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = docs.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (7, None)], "doc_id bigint, toxic int"))
    model = toxicity.fit(docs, labels, queries.fold() != queries.HELD_OUT)
    scored = toxicity.score(docs.withColumn("score", F.lit("clash")), model).withColumn("fold", queries.fold()).collect()
    held = [r for r in scored if r["fold"] == queries.HELD_OUT]
    assert len(held) > 50 and sum(r["predicted"] == r["toxic"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(awkward, model).collect())
    empty = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in toxicity.score(awkward, empty).collect()} == {0.0}


# --- WARC ---------------------------------------------------------------------------------------------------------

def test_archives_come_back(spark):
    long, longer = "<p>é</p>" * 300, "<b>" * 2_000_000
    pages = [(1, "http://a/ b\n", long), (2, None, long), (5, "u", long), (5, "u", long), (3, "u", None), (4, "u", ""), (6, "u", "short"),
             (7, "u", "short"), (None, "u", long), (8, "u", longer)]
    table = spark.createDataFrame([(*p, "extra") for p in pages], "page_id bigint, url string, html string, refers_to string")
    held = stage(spark)
    manifest = warc.write_archives(table.repartition(3), held)
    rows = warc.read_archives(manifest, held).collect()
    assert len(rows) == len(pages) == sum(r["records"] for r in manifest.collect())
    wanted = collections.Counter()
    for page_id, _, html in pages:
        payload = (html or "").encode()
        refers = 5 if html == long and page_id != 5 else None      # a page without an id is never the last one
        wanted[page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if refers else "response", refers] += 1
    found = collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows)
    assert found == wanted
    assert {bytes(r["payload"]).decode() for r in rows if r["page_id"] == 8} == {longer}
    assert warc.read_archives(warc.write_archives(table.limit(0), held, "none"), held, "none").count() == 0


def test_damaged_archives_are_told():
    good = warc.record(1, "u", b"x" * 5000) + warc.record(2, "u", b"", refers_to=1)
    assert [r["payload_bytes"] for r in warc.records(io.BytesIO(good))] == [5000, 0]
    plain = gzip.decompress(warc.record(1, "u", b"hello"))
    for held in (good[:-9], good[:40], gzip.compress(plain.replace(b"hello", b"hullo")), gzip.compress(plain[:-6]),
                 gzip.compress(plain + b"more"), b"not gzip at all"):
        with pytest.raises(warc.ArchiveError):
            list(warc.records(io.BytesIO(held)))


def foreign(kind, block, *lines):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{kind}>", *lines, f"Content-Length: {len(block)}"]
    return gzip.compress("WARC/1.0\r\n".encode() + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_standard_records_of_other_writers():
    body = b"hello there"
    chunked = b"5\r\nhello\r\n6;x=1\r\n there\r\n0\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain;\r\n charset=utf-8\r\n%s\r\n\r\n"
    kind = "Content-Type: application/http; msgtype=response"
    digest = hashlib.sha1(body)
    records = [
        (foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"), b"software: x\r\n"),
        (foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "Content-Type: application/http;msgtype=request"), b""),
        (foreign("metadata", b"{}"), b"{}"),
        (foreign("response", http % b"Content-Length: 11" + body, kind), body),
        (foreign("response", http % b"X: y" + body, kind, f"WARC-Payload-Digest: sha1:{digest.hexdigest().upper()}"), body),
        (foreign("response", http % b"Transfer-Encoding: chunked" + chunked, kind, f"WARC-Payload-Digest: SHA1:{digest.hexdigest()}"), body),
        (foreign("response", http % b"Transfer-Encoding: chunked" + chunked, kind,
                 f"WARC-Payload-Digest: sha256:{hashlib.sha256(chunked).hexdigest()}"), body),
        (foreign("revisit", http % b"X: y", kind), None)]
    assert [r["payload"] for r in warc.records(io.BytesIO(b"".join(r for r, _ in records)))] == [p for _, p in records]
    assert warc.hex_digest(f"sha1:{digest.hexdigest().upper()}") == digest.hexdigest()
    assert warc.hex_digest("crc:zz") is None and warc.hex_digest(None) is None
    for bad in (foreign("response", http % b"Content-Length: 12" + body, kind), foreign("metadata", b"{}", "WARC-Block-Digest: sha1:00"),
                foreign("metadata", b"{}", "WARC-Block-Digest: none:00"), foreign("response", http % b"Transfer-Encoding: chunked" + body, kind),
                gzip.compress(b"WARC/1.0\r\nWARC-Type: metadata\r\n\r\n{}\r\n\r\n")):
        with pytest.raises(warc.ArchiveError):
            list(warc.records(io.BytesIO(bad)))


def test_foreign_archives_on_spark(spark):
    held = stage(spark)
    path = held.path("foreign").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/one.warc.gz", "wb") as out:
        out.write(foreign("warcinfo", b"a: b\r\n") + warc.record(4, "u", b"page") + foreign("metadata", b"{}", "WARC-Target-URI: v"))
    manifest = spark.createDataFrame([(f"{path}/one.warc.gz", 3, 0)], "path string, records bigint, bytes bigint")
    rows = warc.read_archives(manifest, held, "foreign").collect()
    assert [(r["page_id"], r["url"], r["record_type"], bytes(r["payload"])) for r in rows] == [
        (None, None, "warcinfo", b"a: b\r\n"), (4, "u", "response", b"page"), (None, "v", "metadata", b"{}")]


def test_token_sample_moves_no_text(spark, awkward):
    sampled = token_counts.sample_counts(awkward, "text")
    assert sampled and sum(sampled.values()) > 100
    df = token_counts.token_counts(awkward, BYTE_JSON)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    many = spark.range(5000, numPartitions=40).select(F.lit("one two").alias("text"))
    assert sum(token_counts.sample_counts(many, "text").values()) == 2 * 32 * token_counts.TASK_TEXTS


def test_license_matching_is_linear_in_the_text():
    started = time.perf_counter()
    found = licenses.scan_text("mit licens " * 450_000)
    assert len(found["spans"]) == 450_000 and found["n_base"] == 0 and found["labels"] == "mit"
    assert found["spans"][-1][1:3] == (899_998, 2)
    assert time.perf_counter() - started < 30


# --- near duplicates ----------------------------------------------------------------------------------------------

def shingle_set(text):
    held = (text or "").lower().split()
    return {tuple(held[i:i + 5]) for i in range(max(1, len(held) - 4))} if held else set()


def groups(pairs, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def copies():
    """Texts with exact copies, chains of near copies, a shared passage, and awkward ones."""
    draw, texts, passage = random.Random(9), [], words(90, 99)
    for g in range(12):
        base = words(draw.choice([30, 120, 250]), g)
        for _ in range(draw.choice([1, 2, 8])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 3])):
                copy[draw.randrange(len(copy))] = draw.choice(["new", "word", "zz"])
            texts.append(" ".join(copy))
            base = copy if draw.random() < 0.5 else base
        texts.append(" ".join(words(60, 1000 + g) + passage + words(60, 2000 + g)))
    return texts + AWKWARD


def test_near_duplicates_equal_brute_force(spark, copies):
    table = spark.createDataFrame(list(enumerate(copies)), "doc_id bigint, text string").withColumn("class_id", F.lit("clash"))
    found = {r["doc_id"]: r for r in probminhash.near_duplicates(table.repartition(3), "doc_id").collect()}
    sets = [shingle_set(t) for t in copies]
    pairs = [(a, b) for a, b in itertools.combinations(range(len(copies)), 2)
             if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    wanted = groups(pairs, range(len(copies)))
    assert {i: r["class_id"] for i, r in found.items()} == wanted
    assert all(r["kept"] == (i == wanted[i]) for i, r in found.items())
    assert probminhash.near_duplicates(table.limit(0), "doc_id").count() == 0


def test_signatures_estimate_probability_jaccard():
    draw = np.random.default_rng(4)
    shared, a, b = (draw.integers(0, 1 << 63, n).astype(np.uint64) for n in (300, 100, 100))
    text = np.repeat([0, 1], 400)
    found = probminhash.signatures(text, np.concatenate([shared, a, shared, b]), np.ones(800), 2, 2000)
    assert abs((found[0] == found[1]).mean() - 300 / 500) < 0.05
    weighted = probminhash.signatures(np.array([0, 0]), np.array([5, 6], np.uint64), np.array([3.0, 1.0]), 1, 4000)
    assert abs((weighted == 5).mean() - 0.75) < 0.04


def test_components_equal_union_find(spark):
    draw = random.Random(1)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7)]
    table = spark.createDataFrame(pairs + [(None, 3)], "a bigint, b bigint")
    wanted = groups(pairs, {i for p in pairs for i in p})
    found = {r["id"]: r["component"] for r in components.components(table, stage(spark), "c").collect()}
    linked = {i for a, b in pairs if a != b for i in (a, b)}
    assert found == {i: wanted[i] for i in linked}


# --- substrings ---------------------------------------------------------------------------------------------------

def test_chunk_borders_follow_content():
    text = " ".join(words(2000, 5)).encode()
    one, other = (chunks.borders(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in (text, b"some inserted words " + text))
    assert len(set(one.tolist()) & {x - 20 for x in other.tolist()}) > 0.98 * len(one)
    accents = ("é" * 5000).encode()
    assert all(accents[b] & 0xC0 != 0x80 for b in chunks.borders(np.frombuffer(accents, np.uint8), np.array([0, len(accents)]))[:-1])


def test_shared_passages_are_found_and_cut(spark):
    passage = " ".join(words(60, 77))
    texts = [" ".join(words(150, i)) + (f" {passage} " + " ".join(words(100, 50 + i)) if i % 3 == 0 else "") for i in range(12)]
    rows = list(enumerate(texts)) + [(20, None), (21, ""), (None, texts[0]), (22, texts[1]), (23, "é" * 50_000)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, start int")
    spans = chunks.repeated_spans(table, "doc_id").collect()
    assert {(r["doc_id"], r["first_key"]) for r in spans if r["doc_id"] < 20} == {(3, 0), (6, 0), (9, 0)}
    for row in spans:
        assert row["end"] - row["start"] >= chunks.LEAST
        if row["doc_id"] < 20:
            cut = texts[row["doc_id"]].encode()[row["start"]:row["end"]].decode()
            assert cut in f" {passage} " and len(cut) > 0.6 * len(passage)
    after = {(r["doc_id"], r["start"]): r["text"] for r in chunks.remove_repeats(table, "doc_id").collect()}
    assert len(after) == len(rows)
    assert all(after[i, 1] == texts[i] for i in range(12) if i % 3 or i == 0)
    assert after[20, 1] is None and after[21, 1] == "" and after[None, 1] == texts[0] and len(after[22, 1]) < 200
    assert chunks.remove_repeats(table.limit(0), "doc_id").count() == 0


def test_planted_passages_of_51_to_80_words_are_cut_to_the_byte(spark):
    rows, wanted = [], {}
    for i in range(240):
        passage = " ".join(words(51 + i % 30, 5000 + i))
        for copy in range(3):
            head, tail = (" ".join(words(80, 10_000 + 10 * i + 2 * copy + side, f"{'ijklmnop' if side else 'qrstuvwx'}")) for side in (0, 1))
            rows.append((3 * i + copy, f"{head}{'#é!'[copy]}{passage}{'%&ü'[copy]}{tail}"))
            start = len(f"{head}{'#é!'[copy]}".encode())
            if copy:
                wanted[3 * i + copy] = (start, start + len(passage), 3 * i)
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [(r["doc_id"], (r["start"], r["end"], r["first_key"])) for r in chunks.repeated_spans(table, "doc_id").collect()]
    assert len(found) == len(wanted) and dict(found) == wanted


def test_cut_bytes_equal_windows_that_an_earlier_place_holds(spark):
    draw = random.Random(12)
    passages = [" ".join(words(draw.randint(30, 90), 900 + i)) for i in range(15)]
    texts = [" | ".join([" ".join(words(draw.randint(5, 60), 100 + i)), *draw.sample(passages, draw.randint(0, 3)),
                         " ".join(words(20, 300 + i, "uvwxyz"))]) for i in range(60)]
    texts += [texts[7], f"{passages[0]} - {passages[0]}", "round and " * 300]
    spans = chunks.repeated_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "doc_id").collect()
    seen, size, wanted, held, stray = {}, chunks.LEAST, 0, 0, 0
    for i, text in enumerate(t.encode() for t in texts):
        repeated, cut = bytearray(len(text)), bytearray(len(text))
        for a in range(len(text) - size + 1):
            doc, place = seen.setdefault(text[a:a + size], (i, a))
            if (doc, place) != (i, a) and (doc != i or place + size <= a):        # overlap with itself is no repeat
                repeated[a:a + size] = b"\1" * size
        for r in spans:
            if r["doc_id"] == i:
                cut[r["start"]:r["end"]] = b"\1" * (r["end"] - r["start"])
        wanted, held = wanted + sum(repeated), held + sum(x & y for x, y in zip(repeated, cut))
        stray += sum(y & ~x & 1 for x, y in zip(repeated, cut))
    assert wanted > 10_000 and held >= 0.98 * wanted and stray == 0


# --- vectors ------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(3)
    centre = draw.standard_normal((6, 16))
    held = (centre[draw.integers(0, 6, 900)] + 0.8 * draw.standard_normal((900, 16))).tolist()
    for i in range(0, 300, 3):
        held[i + 300] = (np.array(held[i]) + 0.05 * draw.standard_normal(16)).tolist()
    held += [held[1]] * 40 + [None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [1.0, 2.0]]
    rows = [(i, v, (i % 300) % 3 if i % 50 else None) for i, v in enumerate(held)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("label", T.IntegerType())])
    return rows, spark.createDataFrame(rows, schema).withColumn("score", F.lit("clash"))


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_vector_links_equal_brute_force(vectors):
    rows, table = vectors
    good = [(i, np.array(v, np.float32).astype(float), label) for i, v, label in rows if usable(v) and label is not None]
    pairs = [(a, b) for (a, x, p), (b, y, q) in itertools.combinations(good, 2)
             if p == q and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= itq.SIMILARITY]
    links, wanted = collections.Counter(i for p in pairs for i in p), groups(pairs, [r[0] for r in rows])
    found = {r["vec_id"]: r for r in itq.near_duplicate_vectors(table).collect()}
    assert len(found) == len(rows)
    assert sum(found[i]["n_links"] for i in found) >= 0.99 * 2 * len(pairs) > 0
    assert all(found[i]["n_links"] <= links[i] for i in found)
    assert sum(found[i]["component_id"] == wanted[i] for i in found) >= 0.99 * len(found)


def cluster_table(n, share, size, seed, noise=0.22):
    """Unit vectors of which a share are near copies of one another (cosine 0.93 to 0.99), the others at random."""
    draw = np.random.default_rng(seed)
    held = draw.standard_normal((n, size))
    inside = int(n * share)
    centre = draw.standard_normal(size)
    held[:inside] = centre / np.linalg.norm(centre) + noise * draw.standard_normal((inside, size)) / np.sqrt(size)
    return held / np.linalg.norm(held, axis=1, keepdims=True)


@pytest.mark.parametrize("n, share", [(1000, 0.1), (1000, 0.33), (1000, 0.45), (1000, 0.6), (600, 1.0), (2, 1.0), (3, 1.0), (7, 0.5),
                                      (20, 0.3), (20, 1.0)])
@pytest.mark.parametrize("size", [16, 64])
def test_codes_find_the_links_of_large_clusters(n, share, size):
    for seed in range(3):
        held = cluster_table(n, share, size, seed)
        near = held @ held.T >= itq.SIMILARITY
        a, b = np.nonzero(np.triu(near, 1))
        if not len(a):
            continue
        codes = itq.Codes(held, size)
        found = codes.substrings(held)
        differing = np.bitwise_count(found[a] ^ found[b])
        hit = (differing <= 1).any(axis=1) & (differing.sum(axis=1) <= int(found.shape[1] * codes.width * codes.radius))
        assert hit.mean() >= 0.99


def test_codes_find_links_that_the_sample_does_not_hold():
    """Fitted on a third of the rows, of which 45 % are near copies; wider substrings."""
    held = cluster_table(3000, 0.45, 64, 9)
    for width in (16, 20):
        codes = itq.Codes(held[::3], 64, width=width)
        found = codes.substrings(held)
        a, b = (x[::50] for x in np.nonzero(np.triu(held @ held.T >= itq.SIMILARITY, 1)))
        assert (np.bitwise_count(found[a] ^ found[b]) <= 1).any(axis=1).mean() >= 0.99


def test_rows_that_share_an_id_are_vectors_of_their_own(spark):
    one, other = [1.0, 0.0, 0.0], [0.0, 1.0, 0.1]
    rows = [(1, one, 0), (2, [1.0, 0.01, 0.0], 0), (1, other, 0), (5, [0.0, 1.0, 0.11], 0), (3, one, 0), (9, other, 1)]
    found = itq.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == [
        (1, 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (5, 1, 1, False), (9, 0, 9, True)]


def test_nearest_rows(vectors):
    rows, table = vectors
    found = collections.defaultdict(list)
    for r in forest.nearest(table, F.col("vec_id") % 100 == 0).collect():
        found[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    good = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if usable(v)}
    hits = 0
    assert set(found) == {i for i in good if i % 100 == 0}
    for query, got in found.items():
        truth = sorted((float(np.sqrt(((good[query] - v) ** 2).sum())), i) for i, v in good.items() if i != query and len(v) == 16)[:10]
        got = sorted(got)
        assert [g[0] for g in got] == list(range(1, 11)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
        hits += len({g[2] for g in got} & {i for _, i in truth})
    assert hits >= 9 * len(found)
    assert forest.nearest(table.limit(0), F.lit(True)).count() == 0
    assert forest.nearest(table.where("vec_id in (0, 2)"), F.lit(True)).count() == 2


# --- pipeline -----------------------------------------------------------------------------------------------------

def test_pipeline_stages_equal_plain_versions(spark, copies, tmp_path):
    import corpus_pipeline

    draw, vocabulary = random.Random(6), words(300, 8)
    toxic = [" ".join([*draw.choices(vocabulary, k=40), *draw.choices(["zorgblat", "quxxor"], k=5)]) for _ in range(40)]
    texts = [*copies, *toxic]
    rows = [(i if i != 3 else None, t, "en", None, len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame([*rows, rows[0]], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i >= len(copies))) for i in range(len(texts))], "doc_id bigint, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    clean = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    left = [r["doc_id"] for r in clean.collect()]
    assert {i for i in left if i is not None and i >= len(copies)} == set()
    assert len(left) >= 0.95 * (len(copies) + 1)
    single = corpus_pipeline.drop_near_duplicates(spark, clean, str(tmp_path))
    kept = {r["doc_id"]: r["text"] for r in single.collect()}
    assert single.count() == len(kept) and single.columns == docs.columns
    sets = {i: shingle_set(t) for i, t in kept.items() if i is not None}
    assert not [1 for a, b in itertools.combinations(sets, 2) if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    cut = corpus_pipeline.cut_repeats(spark, single, str(tmp_path))
    assert cut.columns == docs.columns and cut.count() == len(kept)
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect() if r["text"] is not None)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    library = Tokenizer.from_file(WORD_JSON)
    lengths = {}
    for r in packed.collect():
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in cut.collect()}


def test_queries_have_no_pairwise_plan(spark):
    for name in ("op1_warc_archives", "op8_repeated_spans", "op7_nearest_vectors"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_crc_of_pieces(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string")
    row = packing.token_pieces(docs, WORD_JSON, digest=True).first()
    ids = [*Tokenizer.from_file(WORD_JSON).encode("some words here", add_special_tokens=False).ids, 1]
    assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
