"""Sharding, repair of conversations and the Merkle manifest against SQL on odd tables and brute-force versions."""

import datetime as dt
import hashlib
import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import plan
from jobgauge.llm import merkle, repair, sharding
from jobgauge.llm.queries import ORACLES, QUERIES

LONG = "word " * 30_000 + "é\nend"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, slot bigint, document string, rank int, total int, tree int, at int, part int, digest int"
TURNS = "conv_id bigint, turn bigint, role string, text string, rank int, total int, chunk int, fault int, path int, cost int, edit int, first int"


def _documents(rows):
    return [(i, t, lang, s, n, 7, 8, "x", 1, 2, 3, 4, 5, 6) for i, t, lang, s, n in rows]


def _odd_documents(rng, count):
    rows = [(None, None, None, None, None), (None, "a\nb", "en", "s1", 3), (None, "a\nb", "en", "s1", 3), (4, LONG, None, "é", 9), (4, LONG, None, "é", 9)]
    rows += [(5, "", "", "", 0), (5, "one", "en", None, 3), (5, "two\n", "en", None, -4)]
    return _documents(rows + [(rng.randrange(count), rng.choice("abc") * rng.randrange(4) + "\n", "en", rng.choice(["hot", "hot", "s1", None]), 1) for _ in range(count)])


def _turns(rows):
    return [(*row, 1, 2, 3, 4, 5, 6, 7, 8) for row in rows]


def _odd_turns(rng, count):
    rows = [(None, None, None, None), (None, 2, "user", LONG), (77, -(2**61), "user", "a."), (77, 2**61, "assistant", "b!"), (78, 5, "", ""), (78, 5, "", "")]
    roles = ["user", "assistant", "system", "tool", "assistant", "user", ""]
    for conv in range(count):
        rows += [(conv, rng.choice([t, t, t, None, 3]), rng.choice(roles), rng.choice(["Yes.", "No", " \t", "x? ", "é!", None])) for t in range(rng.randrange(9))]
    return _turns(rows)


@pytest.mark.parametrize("name", ["op11_sharding", "op12_repair", "op13_merkle"])
@pytest.mark.parametrize("size", [0, 1, 260])
def test_odd_tables_match_sql(spark, path, name, size):
    rng = random.Random(size)
    documents = _odd_documents(rng, size) if size > 1 else _documents([(3, "x\ny", "en", "s", 1)][:size])
    turns = _odd_turns(rng, size) if size > 1 else _turns([(3, 0, "user", "hello")][:size])
    folder = path("tables")
    spark.createDataFrame(documents, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(turns, TURNS).write.parquet(f"{folder}/conversations.parquet")
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    df = QUERIES[name](spark, folder)
    expected = duck.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == sorted(expected.fetchall(), key=repr)


# Sharding


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 10, 26, 100, 1000, 4097])
def test_shuffle_is_a_permutation_with_a_way_back(spark, rows):
    shuffle = sharding.shuffle_of(spark, rows)
    assert rows <= shuffle.high * shuffle.low < rows + shuffle.high
    number = F.col("id")
    found = spark.range(rows).select(
        "id", shuffle.place(number).alias("place"), shuffle.shard(number).alias("shard"), shuffle.slot(number).alias("slot")
    )
    back = found.select("*", shuffle.number(F.col("place")).alias("back"), shuffle.number_at(F.col("shard"), F.col("slot")).alias("at")).collect()
    assert sorted(r.place for r in back) == list(range(rows))
    assert all(r.back == r.id == r.at for r in back)


def test_shuffle_follows_chains_of_cells_beyond_the_last_row(spark):
    walks = {rows: sharding.shuffle_of(spark, rows, rounds=1).walks for rows in (2, 3, 5, 11, 13)}
    assert max(walks.values()) > 0
    for rows in walks:
        shuffle = sharding.shuffle_of(spark, rows, rounds=1)
        places = [r.p for r in spark.range(rows).select(shuffle.place(F.col("id")).alias("p")).collect()]
        assert sorted(places) == list(range(rows))


def test_shards_do_not_depend_on_files_and_keep_the_rows(spark, path):
    rows = _odd_documents(random.Random(9), 300)
    df = spark.createDataFrame(rows, DOCUMENTS)
    one = sharding.shard_documents(df.coalesce(1)).collect()
    many = sharding.shard_documents(df.repartition(13)).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, many))
    assert sorted((tuple(r.document) for r in one), key=repr) == sorted(rows, key=repr)
    slots = {shard: sorted(r.slot for r in one if r.shard == shard) for shard in range(8)}
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and all(s == list(range(len(s))) for s in slots.values())
    by_number = sorted(one, key=lambda r: r.number)
    places = [r.slot * 8 + r.shard for r in by_number]
    assert 0.35 < sum(a < b for a, b in zip(places, places[1:])) / len(places) < 0.65
    assert sharding.shard_documents(df, seed="other").filter("shard = 0").count() in (min(sizes), max(sizes))
    sharding.write_shards(sharding.shard_documents(df), path("shards"))
    back = spark.read.parquet(path("shards"))
    assert back.count() == len(rows) and back.select("shard").distinct().count() == 8


def test_sharding_is_native(spark):
    text = plan(sharding.shard_documents(spark.createDataFrame(_documents([(1, "a", "b", "c", 1)]), DOCUMENTS)))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


# Repair of conversations


def _legal(initials):
    if initials[:1] == "s":
        initials = initials[1:]
        return bool(initials) and initials == "ua" * (len(initials) // 2)
    return initials == "ua" * (len(initials) // 2)


def _cheapest(rows):
    """By trying every audit: rows of role initial and fault; cost and audit."""
    best = None
    gaps = ["", "I", "II"]
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product("DKR", repeat=len(rows)):
            cost, initials, audit = 0, "", ""
            for insert, edit, (initial, fault) in zip(inserts, edits, rows):
                for _ in insert:
                    initials += "a" if initials[-1:] == "u" else "u"
                cost += repair.INSERT * len(insert)
                if edit == "D":
                    cost += repair.DELETE
                elif fault in ("blank", "duplicate"):
                    break
                else:
                    cost += (repair.REROLE if edit == "R" else 0) + (repair.TRUNCATED if fault == "truncated" else 0)
                    initials += initial if edit == "K" else ("a" if initials[-1:] == "u" else "u")
                audit += insert + edit
            else:
                for _ in inserts[-1]:
                    initials += "a" if initials[-1:] == "u" else "u"
                cost += repair.INSERT * len(inserts[-1])
                if _legal(initials) and (best is None or (cost, audit + inserts[-1]) < best):
                    best = cost, audit + inserts[-1]
    return best


def _solved(rows):
    chunk = repair._Chunk(None, 0, True)
    for initial, fault in rows:
        chunk.add("sua".find(initial) + 1, fault)
    result = chunk.result()
    return result["costs"][0], result["paths"][0][::2]


def test_survivors_find_the_cheapest_and_least_audit():
    rng = random.Random(12)
    for _ in range(150):
        rows = [(rng.choice("suuaat"), rng.choice([None, None, None, "truncated", "blank"])) for _ in range(rng.randrange(5))]
        assert (_solved(rows) if rows else (0, "")) == _cheapest(rows), rows


def test_unresolved_edits_stay_few():
    rng = random.Random(4)
    survivors, deepest, certain = repair.Survivors(repair.START), 0, []
    for i in range(20_000):
        certain += survivors.step(rng.randrange(4), rng.random() < 0.1, rng.random() < 0.2)
        deepest = max([deepest, *(len(survivors.path(leaf)) for leaf in survivors.leaf.values())])
    assert deepest < 100 and len(certain) > 19_000
    nodes = {id(n): n for leaf in survivors.leaf.values() for n in iter_up(leaf)}
    uses = {key: 0 for key in nodes}
    for node in nodes.values():
        if node.before is not None:
            uses[id(node.before)] += 1
    for leaf in survivors.leaf.values():
        uses[id(leaf)] += 1
    assert all(nodes[key].uses == count for key, count in uses.items())


def iter_up(node):
    while node is not None:
        yield node
        node = node.before


def test_long_conversations_are_cut_without_a_change(spark):
    rng = random.Random(21)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice([f"{t}.", f"{t}", "same.", " "])) for t in range(500)]
    rows += [(None, t, rng.choice(["user", "assistant"]), f"{t}?") for t in range(40)] + [(2, 0, "user", "only")]
    turns = spark.createDataFrame(_turns(rows), TURNS).cache()
    whole, cut = repair.repair(turns), repair.repair(turns, chunk_rows=7)
    for a, b in ((whole.summary, cut.summary), (whole.turns, cut.turns), (whole.edits, cut.edits), (whole.faults, cut.faults)):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    out = sorted(whole.turns.filter("conv_id = 1").collect(), key=lambda r: (r["rank"], r.part))
    assert _legal("".join(r.role[0] for r in out))
    by_rank = {r["rank"]: r for r in whole.faults.filter("conv_id = 1").collect()}
    assert all(by_rank[r["rank"]].fault in (None, "truncated") for r in out if r.edit != "I")
    assert sum(r.edit == "K" for r in out) == whole.summary.filter("conv_id = 1").first().audit.count("K")


# Merkle manifest


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _plain_tree(leaves):
    """Root, and for each leaf the digests beside it, from the leaf up."""
    beside, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, place in enumerate(at):
            run = place // 3 * 3
            beside[i].append(("".join(level[run:place]), "".join(level[place + 1 : run + 3])))
        level = [_h(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [place // 3 for place in at]
    return level[0], beside


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_manifest_matches_a_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BUCKET_LEVELS", levels)
    monkeypatch.setattr(merkle, "BUCKET", 3**levels)
    rng = random.Random(levels)
    rows = [(i, rng.choice(["hot"] * 4 + [None, "a", "B", "é", ""])) for i in range(400)]
    df = spark.createDataFrame([(i, s, f"t{i}", 0) for i, s in rows], "doc_id long, source string, text string, digest int").repartition(5)
    leaf = merkle.leaf_digest([F.col("doc_id"), F.col("text")])
    made = merkle.manifest(df, leaf)
    trees = {}
    for i, source in rows:
        trees.setdefault(source, []).append((i, _h(f"{len(str(i))}:{i}", f"{len(str(i)) + 1}:t{i}")))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    plain = {s: _plain_tree([d for _, d in sorted(trees[s])]) for s in trees}
    root, over = _plain_tree([plain[s][0] for s in order])
    expected = {}
    for s in trees:
        for (i, digest), beside in zip(sorted(trees[s]), plain[s][1]):
            expected[i] = (s, digest, plain[s][0], beside + over[order.index(s)])
    assert made.root == root
    found = {r.carried: (r.tree, r.leaf, r.subroot, [tuple(step) for step in r.proof]) for r in made.proofs.collect()}
    assert found == expected
    assert made.proofs.filter(merkle.folded(F.col("leaf"), F.col("proof")) != root).isEmpty()
    nodes = made.nodes.collect()
    tops = [n for n in nodes if n.top]
    assert [n.digest for n in tops if n.level == max(t.level for t in tops)] == [root]
    hot = sorted((n.level, n.first, n.digest) for n in nodes if n.tree == "hot")
    assert len(hot) == len(set((level, first) for level, first, _ in hot)) and hot[-1][2] == plain["hot"][0]


def test_leaf_digest_of_types(spark):
    row = spark.createDataFrame([("é", None, 5, dt.date(2024, 1, 2))], "a string, b string, c int, d date")
    digest = row.select(merkle.leaf_digest([F.col(c) for c in row.columns])).first()[0]
    assert digest == _h("2:é", "-", "1:5", "10:2024-01-02")
