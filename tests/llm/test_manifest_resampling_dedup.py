"""Merkle manifest, importance resampling and exact deduplication against plain second versions, and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from posada.llm import exact_dedup, merkle, queries, ranks, resampling
from posada.llm.common import stage
from posada.llm.oracles import ORACLES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- places ---------------------------------------------------------------------------------------------------

def test_places_inside_groups(spark):
    draw = random.Random(1)
    rows = [(draw.choice("aaaaab"), draw.randint(0, 40), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    found = ranks.numbered(df, stage(spark), "n", ["g"], [F.col("v").desc(), "i"]).collect()
    for g in "ab":
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        got = sorted((r["place"], r["i"], r["total"]) for r in found if r["g"] == g)
        assert got == [(n, r[2], len(mine)) for n, r in enumerate(mine)]
    assert ranks.numbered(df.limit(0), stage(spark), "n", [], ["v"]).count() == 0


# --- Merkle manifest ------------------------------------------------------------------------------------------

def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def plain_up(nodes):
    return [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]


def plain_path(nodes, at):
    """The proof of one node, computed anew from the whole tree."""
    out = []
    while len(nodes) > 1:
        first = at // 16 * 16
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + 16])))
        nodes, at = plain_up(nodes), at // 16
    return out, nodes[0]


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof digest) of each row."""
    trees = collections.defaultdict(list)
    for row in rows:
        trees[row[3]].append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: [plain_leaf(r) for r in sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))] for s in order}
    subroots = [plain_path(leaves[s], 0)[1] for s in order]
    out = []
    for n, s in enumerate(order):
        upper, root = plain_path(subroots, n)
        keys = sorted((r[0] is not None, r[0] or 0, plain_leaf(r)) for r in trees[s])
        for i, (known, key, leaf) in enumerate(keys):
            proof = plain_path(leaves[s], i)[0] + upper
            out.append((key if known else None, leaf, subroots[n], root, sha("".join(a + b for a, b in proof))))
    return out


def document_rows(counts, seed=4):
    draw = random.Random(seed)
    rows = []
    for source, n in counts.items():
        for _ in range(n):
            rows.append((len(rows) * 7 % 9973, "".join(draw.choices("abÇ é中AB", k=draw.randint(0, 9))), draw.choice([None, "en"]), source,
                         draw.choice([None, 3])))
    return rows


def manifest_of(spark, rows, **levels):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"leaf": F.lit("x"), "tree": F.lit(1), "place": F.lit(2)})
    claimed = F.when(F.col("doc_id") % 3 == 0, merkle.leaf_digest([F.lower(c) if c == "text" else F.col(c) for c in FIELDS]))
    return merkle.manifest(df, stage(spark), "doc_id", "source", FIELDS, claimed, **levels).collect()


@pytest.mark.parametrize("counts, levels", [
    ({"hot": 700, None: 1, "": 2, "one": 1, "b": 17}, {}),
    ({f"s{i}": 1 + i % 3 for i in range(40)} | {"long": 90}, {"leaf_levels": 1, "node_levels": 1}),
    ({"only": 1}, {}), ({"only": 300}, {"leaf_levels": 1, "node_levels": 1})])
def test_manifest_equals_the_whole_tree(spark, counts, levels):
    rows = document_rows(counts)
    found = manifest_of(spark, rows, **levels)
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], sha("".join(a + b for a, b in zip(r["lefts"], r["rights"])))) for r in found]
    assert sorted(got, key=repr) == sorted(plain_manifest(rows), key=repr)
    text = {r[0]: r[1] for r in rows}
    for r in found:
        assert merkle.fold(r["leaf"], r["lefts"], r["rights"]) == r["root"]
        changed = r["doc_id"] % 3 == 0 and text[r["doc_id"]].lower() != text[r["doc_id"]]
        assert r["verified"] == (not changed) == (r["folded_root"] == r["root"])


def test_manifest_of_awkward_rows(spark):
    same = (5, "twice", "en", "s", 5)
    rows = [same, same, (5, "other", "en", "s", 5), (None, None, None, None, None), (None, "", None, "s", None), (1, "x" * 70_000, "", "", 0)]
    found = manifest_of(spark, rows)
    assert len(found) == 6 and len({r["root"] for r in found}) == 1
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], sha("".join(a + b for a, b in zip(r["lefts"], r["rights"])))) for r in found]
    assert sorted(got, key=repr) == sorted(plain_manifest(rows), key=repr)
    assert manifest_of(spark, []) == []


# --- importance resampling ------------------------------------------------------------------------------------

def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_buckets(text):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resample(rows, target, share, least):
    source, wanted = collections.Counter(), collections.Counter()
    for _, text in rows:
        source.update(plain_buckets(text))
    for text in target:
        wanted.update(plain_buckets(text))
    all_s, all_t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (all_s + 10_000) / ((source[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    scored = []
    for key, text in rows:
        held = plain_buckets(text)
        h = int(sha(f"42:{'' if key is None else key}")[:8], 16)
        weight = sum(gain[b] for b in held)
        scored.append([key, len(plain_words(text)), len(held), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))])
    able = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for n, row in enumerate(able):
        row.append(n + 1 if n < len(able) * share[0] // share[1] else None)
    return [tuple(r if len(r) == 6 else [*r, None]) for r in scored]


def resampled(spark, rows, target, share=(5, 100), least=20):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("score", "rank", "n_words", "bucket")})
    goal = spark.createDataFrame([(t,) for t in target], "text string").withColumn("n", F.lit(1))
    found = resampling.resample(df.repartition(5), goal, stage(spark), share=share, least_words=least)
    return [tuple(r) for r in found.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]


@pytest.mark.parametrize("block", [1, 7, 40, 1 << 20])
def test_runs_do_not_depend_on_blocks(monkeypatch, block):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", block)
    for text in ("", "...", "one", "Two words", "a b c", "Ünï-çode 中文, MIXED Case_9 and\x00 more; x  y", "word " * 50, " lead and trail "):
        found = list(resampling.runs(text.encode()))
        assert sum(n for n, _ in found) == len(plain_words(text))
        assert collections.Counter(c % 10_000 for _, sums in found for c in sums.tolist()) == collections.Counter(plain_buckets(text))


def test_resampling_equals_plain_version(spark):
    draw = random.Random(8)
    vocabulary = ["Red", "blue", "green", "été", "x9", "up", "down"]
    rows = [(i * 13 % 401 if i % 50 else None, " ".join(draw.choices(vocabulary, k=draw.randint(0, 40)))) for i in range(400)]
    rows += [(1, None), (2, ""), (3, "long " * 30_000)]
    target = ["red blue red blue", None, "été x9 up"]
    for share, least in (((5, 100), 20), ((1, 3), 0), ((1, 1), 5)):
        assert sorted(resampled(spark, rows, target, share, least), key=repr) == sorted(plain_resample(rows, target, share, least), key=repr)


def test_resampling_draws_exactly_as_many_of_equal_rows(spark):
    text = "the same twenty words again " * 5
    rows = [(7, text)] * 90 + [(9, text)] * 5 + [(None, text)] * 5
    found = resampled(spark, rows, ["the same"], (1, 2))
    assert sorted(r[5] for r in found if r[5]) == list(range(1, 51)) and len(found) == 100
    noise = {r[0]: r[4] for r in found}
    best = max(noise, key=noise.get)
    assert sum(r[0] == best for r in found if r[5]) == min(50, sum(r[0] == best for r in found))
    assert resampled(spark, [], ["a"]) == [] and all(r[5] is None for r in resampled(spark, rows[:3], []))


# --- exact deduplication --------------------------------------------------------------------------------------

def plain_dedup(rows):
    """(key, keep_key, group_size, kept, digest); keys must differ for kept to be plain."""
    groups = collections.defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), key is None, key, text))
    out = []
    for body, held in groups.items():
        best = min(held, key=lambda r: r[:2] + (r[2] or 0,))
        out += [(key, best[2], len(held), key == best[2], sha(body)) for _, _, key, _ in held]
    return out


def write(spark, rows, path, files=3, mode="overwrite"):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("digest", "key", "row", "n")})
    df.repartition(files).write.mode(mode).parquet(path)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_key", "group_size", "kept", "digest").collect()), key=repr)


TEXTS = [None, "", " \t\n", "a b", "ab", "a\x0bb", "a b", "A b", "é\r\n é", "éé", "x" * 70_000, "x " * 70_000]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "hot copy") for i in range(60)] + [(200, "hot  copy"), (201, "hot  copy"), (None, "none")]



@pytest.mark.parametrize("per_batch", [1, 100])
def test_exact_dedup_equals_plain_version(spark, per_batch):
    held = stage(spark)
    write(spark, ROWS, held.path("in"))
    assert result(exact_dedup.deduplicate(spark, held.path("in"), held, files_per_batch=per_batch)) == sorted(plain_dedup(ROWS), key=repr)


def test_equal_digests_of_different_texts_are_told_apart(spark):
    held = stage(spark)
    write(spark, ROWS, held.path("in"))
    weak = exact_dedup.deduplicate(spark, held.path("in"), held, digest=lambda body: F.substring(F.sha2(body, 256), 1, 1))
    got = [r[:4] for r in result(weak)]
    assert sorted(got, key=repr) == sorted((r[:4] for r in plain_dedup(ROWS)), key=repr)


def test_later_files_meet_the_state_of_earlier_ones(spark):
    held = stage(spark)
    path, folder = held.path("in"), held.path("kept")
    write(spark, ROWS[:30], path)
    first = exact_dedup.deduplicate(spark, path, held, folder=folder)
    assert result(first) == sorted(plain_dedup(ROWS[:30]), key=repr)
    write(spark, ROWS[30:], path, mode="append")
    again = stage(spark)
    assert result(exact_dedup.deduplicate(spark, path, again, folder=folder)) == sorted(plain_dedup(ROWS), key=repr)
    before = exact_dedup.registry(spark, folder).agg(F.sum("group_size")).first()[0]
    exact_dedup.absorb(spark, path, folder, "doc_id", "text")
    assert exact_dedup.registry(spark, folder).agg(F.sum("group_size")).first()[0] == before == len(ROWS)


def test_exact_dedup_of_repeated_rows_and_of_nothing(spark):
    held = stage(spark)
    write(spark, [(1, "same")] * 4 + [(None, "same")], held.path("in"))
    found = exact_dedup.deduplicate(spark, held.path("in"), held).collect()
    assert len(found) == 5 and sum(r["kept"] for r in found) == 1 and {r["keep_key"] for r in found} == {1}
    write(spark, [], held.path("none"), 1)
    assert exact_dedup.deduplicate(spark, held.path("none"), stage(spark)).count() == 0


def test_exact_dedup_plan_has_no_python(spark):
    plan = queries.op13_exact_dedup(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


# --- queries --------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = sorted(d[0] for d in cursor.description)
    order = [[d[0] for d in cursor.description].index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    found = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == columns
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == want
