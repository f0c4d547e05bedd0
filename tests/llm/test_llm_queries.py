"""Every query of the dealt operators and the pipeline against SQL or a brute-force version."""

import hashlib
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import plan
from jobgauge.llm import decontaminate, jaccard_join, line_dedup, quality
from jobgauge.llm.queries import ORACLES, QUERIES
from jobgauge.sources.scratch import written

SF_DIR = "/root/testdata/sf0.001"
NATIVE = ("op1_chat_format", "op2_line_dedup", "op8_mixing")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == sorted(expected.fetchall(), key=repr)
    assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)
    if name in NATIVE:
        assert not re.search("Python|Pandas|Arrow", plan(df))


def _base(text):
    """The contract's patterns, taken literally."""
    name = r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, m.end(), "assign") for m in re.finditer(name, text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans)]


def test_secret_scan_keeps_all_base_findings(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op3_secret_scan"](spark, sf_dir).collect()
    assert sorted(row.doc_id for row in rows) == sorted(texts)
    found = 0
    for row in rows:
        base = _base(texts[row.doc_id] or "")
        found += len(base)
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex")]
        assert set(base) <= set(row.spans.split(","))
    assert found > 0


def test_quality_of_unseen_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op4_quality"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    counts = scored.filter("held_out").join(labels, "doc_id").groupBy("quality", "predicted").count().collect()
    by = {(row.quality, row.predicted): row["count"] for row in counts}
    assert by[1, 1] / (by[1, 1] + by.get((1, 0), 0)) > 0.97
    assert by[0, 0] / (by[0, 0] + by.get((0, 1), 0)) > 0.9
    assert scored.filter("score < 0 OR score > 1 OR score IS NULL").isEmpty()


def _shingles(text, length=corpus_pipeline.SHINGLE_WORDS):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))} if words else set()


def test_pipeline_matches_a_plain_version(spark, duck, texts):
    sources = dict(duck.execute("SELECT doc_id, source FROM documents").fetchall())
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = quality.fit_quality(documents, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    good = {r.doc_id for r in quality.score_quality(documents, model).filter("_score >= 0.5").collect()}
    docs = {i: texts[i] for i in sorted(good)}

    spread, first = {}, {}
    for i, text in docs.items():
        for line in text.split("\n"):
            key = re.sub(r"[\t\r]", " ", line).strip(" ")
            spread.setdefault(key, set()).add(sources[i])
            first.setdefault(key, i)
    cut = {}
    for i, text in docs.items():
        keys = [(re.sub(r"[\t\r]", " ", line).strip(" "), line) for line in text.split("\n")]
        kept = [line for key, line in keys if not key or len(spread[key]) < line_dedup.MIN_SITES or first[key] == i]
        if len(kept) == len(keys) or "\n".join(kept).strip():
            cut[i] = "\n".join(kept)

    sets = {i: _shingles(text) for i, text in cut.items()}
    root = {i: i for i in cut}

    def find(i):
        return i if root[i] == i else find(root[i])

    ids = list(cut)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= corpus_pipeline.PERCENT * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    single = {i: cut[i] for i in cut if find(i) == i}

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))

    windows = set()
    for (text,) in duck.execute("SELECT text FROM benchmark").fetchall():
        w = words(text)
        windows |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)} if len(w) >= 10 else {tuple(w)} - {()}
    sizes = {}
    for i, text in single.items():
        w = words(text)
        hit = set()
        for k in {len(window) for window in windows}:
            for at in range(len(w) - k + 1):
                if tuple(w[at : at + k]) in windows:
                    hit |= set(range(at, at + k))
        if len(hit) <= decontaminate.MOST_COVERAGE * len(w):
            spans = decontaminate.merged([(at, at + 1) for at in sorted(hit)])
            clean = decontaminate.cut_words(text, [(s["first"], s["end"]) for s in spans]) if hit else text
            sizes[i] = len(re.findall(r"[^\x20\x09-\x0D]+", clean))

    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {row.doc_id: row.size for row in rows} == sizes
    assert len(sizes) < len(good) < len(texts)
    by_source = {}
    for row in rows:
        assert row.taken <= 3 * row.size
        total = by_source.setdefault(row.source, [0, row.target])
        total[0] += row.taken
    assert all(abs(taken - target) <= 1 for taken, target in by_source.values())


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).dtypes == docs.dtypes
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_topk_without_pruning_limits(spark):
    vectors = spark.range(300).select(
        F.col("id").alias("vec_id"), F.array(*[F.lit(1.0) for _ in range(3)]).alias("embedding")
    )
    from jobgauge.llm.topk import top_k

    rows = top_k(vectors, F.col("vec_id") % 100 == 0, 5, shard_vectors=64).collect()
    expected = {0: [1, 2, 3, 4, 5], 100: [0, 1, 2, 3, 4], 200: [0, 1, 2, 3, 4]}
    assert {q: [r.vec_id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] for q in expected} == expected


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_every_candidate_of_a_linked_pair_is_found_without_sketches(percent):
    """Sets that differ by as much as is allowed share a key and have near sketches, whatever their size."""
    rng = np.random.default_rng(5)
    linked = 0
    for size in [1, 2, 5, 6, 7, 12, 13, 20, 57, 150, 300, 1000]:
        for _ in range(30):
            differ = int(rng.integers(0, size * (100 - percent) // 100 + 2))
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            gone = int(rng.integers(0, differ + 1))
            b = np.unique(np.concatenate((a[gone:], rng.integers(0, 2**63, differ - gone).astype(np.uint64))))
            common = len(np.intersect1d(a, b))
            if len(b) and (100 + percent) * common >= percent * (len(a) + len(b)):
                linked += 1
                assert len(np.intersect1d(jaccard_join.band_keys(a, percent), jaccard_join.band_keys(b, percent)))
                assert len(np.intersect1d(_frugal(a, percent), _frugal(b, percent)))
                assert _distance(a, b, percent) <= len(a) + len(b) - 2 * common
    assert linked > 150


def _frugal(shingles, percent):
    """The keys without the spare ones, in an order that has nothing to do with the sets."""
    keys, spares = jaccard_join.band_keys(shingles, percent), jaccard_join.spare_keys(shingles, percent)
    codes = keys % np.uint64(jaccard_join.BAND_CODES)
    return np.concatenate([np.sort(keys[codes == code])[spare:] for code, spare in enumerate(spares)])


def _distance(a, b, percent):
    one, two = sorted((jaccard_join.parity_sketch(s, percent) for s in (a, b)), key=len)
    if len(two) > len(one):
        assert len(two) == 2 * len(one)
        two = two[: len(one)] ^ two[len(one) :]
    return int(np.bitwise_count((one ^ two).view(np.uint64)).sum())


@pytest.mark.parametrize("percent", [80, 85])
def test_unrelated_sets_share_no_keys_and_have_distant_sketches(percent):
    rng = np.random.default_rng(6)
    for size in [60, 150, 200, 400, 1000, 3000]:
        seen = []
        for _ in range(40):
            own = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            keys = jaccard_join.band_keys(own, percent)
            for other, their in seen:
                assert not len(np.intersect1d(keys, their))
                assert _distance(own, other, percent) > jaccard_join.most_different(size, size, percent)
            seen.append((own, keys))


def test_sketches_tell_near_copies_beyond_the_limit_apart():
    """In a large group of near copies most pairs are somewhat too far apart; few of them may seem linked."""
    rng = np.random.default_rng(8)
    near = 0
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**64, 147, dtype=np.uint64))
        b = np.unique(np.concatenate((a[16:], rng.integers(0, 2**64, 16, dtype=np.uint64))))  # similar by 80 percent
        near += _distance(a, b, 85) <= jaccard_join.most_different(len(a), len(b), 85)
    assert near <= 10


def test_keys_are_shuffled_a_slice_at_a_time(spark, monkeypatch):
    rows = [(k, c) for k in range(40) for c in range(k % 3 + 1)] + [(7, 0), (900, 5), (900, 5)]
    made = []

    def kept(df, label):
        made.append((label, df._jdf.queryExecution().toString()))
        return written(df, label)

    monkeypatch.setattr(jaccard_join, "written", kept)
    found = jaccard_join._members(spark.createDataFrame(rows, "key long, class long"))
    assert sorted(map(tuple, found.collect())) == sorted({(k, c) for k, c in rows if k % 3 and k < 40})
    slices = [text for label, text in made if label == "members-slice"]
    assert len(slices) == jaccard_join.KEY_SLICES and all("pmod(xxhash64(" in text for text in slices)
    assert all("Exchange" not in text for label, text in made if label == "members")


def test_stages_leave_columns_of_any_name_alone(spark):
    names = ["_score", "_before", "_cut", "_n", "_doc", "_row", "_stays", "_rank", "_spans", "_items", "_n_words", "_hit", "_lines",
             "_removed", "_n_lines", "class", "class2", "root", "of", "key", "a", "b", "size", "extra0"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    wide = docs.select("*", *[F.concat(F.lit(f"{name} of "), "doc_id").alias(name) for name in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF_DIR)
        assert out.dtypes == wide.dtypes
        assert {tuple(r) for r in out.select("doc_id", *docs.columns[2:4]).collect()} == {
            tuple(r) for r in stage(spark, docs, SF_DIR).select("doc_id", *docs.columns[2:4]).collect()
        }
        for row in out.collect():
            assert all(row[name] == f"{name} of {row.doc_id}" for name in names)
