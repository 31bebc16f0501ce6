"""Decontamination, sharding and chat formatting: results, edges, and that no Python runs."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from leadmill.llm import chat, decontam, sharding


def no_python(df):
    return not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def words(x):
    return [w for w in re.split(r"[\W_]+", (x or "").lower()) if w]


def test_decontamination_finds_items(spark, data):
    docs, bench = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: words(r.text) for r in bench.collect()}
    runs = {}
    for i, w in items.items():
        for k in range(len(w) - 12):
            runs.setdefault(tuple(w[k : k + 13]), set()).add(i)
    texts = [(r.doc_id, words(r.text)) for r in docs.collect()]
    want = {(d, i) for d, w in texts for k in range(len(w) - 12) for i in runs.get(tuple(w[k : k + 13]), ())}
    found = decontam.contaminated(docs, bench)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert want and want <= got and all(m >= 13 for m in [r.matched for r in found.collect()])
    left = decontam.clean(docs.withColumn("h", F.lit(1)), bench)
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in got} and "h" in left.columns
    assert no_python(found) and no_python(left)


def test_decontamination_bears_substitutions(spark, data):
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    r, rows = random.Random(3), []
    for x in bench.collect():
        for rate in (0, 10, 20):
            w = [f"zz{r.randrange(9999)}" if r.randrange(100) < rate else t for t in words(x.text)]
            rows.append((rate * 10_000 + x.item_id, "Some words before. " + " ".join(w) + "; and after it"))
    got = {(a.doc_id // 10_000, a.item_id) for a in decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect() if a.doc_id % 10_000 == a.item_id}
    n = bench.count()
    assert [sum(k == rate for k, _ in got) / n for rate in (0, 10)] == [1.0, 1.0] and sum(k == 20 for k, _ in got) >= 0.8 * n


def test_recall_among_items_that_verify(spark, data):
    """Of items with many tokens replaced, those that still meet the threshold (share or stretch, place by place) are found, but for a few."""
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    r, rows, verifies = random.Random(11), [], set()
    for x in bench.collect():
        item = words(x.text)
        for k in range(6):
            w = [f"zz{r.randrange(9999)}" if r.random() < 0.28 else t for t in item]
            same, run, best = [a == b for a, b in zip(w, item, strict=True)], 0, 0
            for hit in same:
                run = max(0, run + (1 if hit else -2))
                best = max(best, run)
            rows.append((k * 10_000 + x.item_id, " ".join(w)))
            if sum(same) >= (0.7 if len(item) >= 8 else 1) * len(item) or best >= 13:
                verifies.add((k * 10_000 + x.item_id, x.item_id))
    got = {(a.doc_id, a.item_id) for a in decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect() if a.doc_id % 10_000 == a.item_id}
    assert got <= verifies and len(verifies) > 20
    assert len(got) >= 0.93 * len(verifies), (len(got), len(verifies))


def test_decontamination_edges(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (2, "a b c"), (2, "a b c"), (3, "what is This, thing?"), (4, "a x b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "is this thing"), (2, None), (3, ""), (None, "a b c")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.place) for r in decontam.contaminated(docs, items).collect()) == [(2, None, 0), (3, 1, 1)]
    assert sorted(str(r.doc_id) for r in decontam.clean(docs, items).collect()) == ["1", "4", "None"]
    assert decontam.contaminated(docs, items.limit(0)).count() == 0 and decontam.contaminated(docs.limit(0), items).count() == 0


def test_shards(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = sharding.digests(docs)
    assert no_python(rows)
    got = rows.toPandas().merge(docs.toPandas(), on="doc_id")
    assert len(got) == docs.count() and set(got["shard"]) <= set(range(24)) and set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    assert all(len(t.encode()) + 8 == n and zlib.crc32(t.encode()) == c for t, n, c in zip(got.text, got["size"], got.text_crc32, strict=True))
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    by = got.groupby("shard")["size"].sum()
    assert abs(by - got["size"].sum() / 24).max() <= got["size"].max()


def test_large_groups_are_cut(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    by = sharding.digests(docs, 7).groupBy("shard").agg(F.sum("size").alias("b")).toPandas().b
    assert len(by) == 7 and by.max() - by.min() <= 0.01 * by.mean()


def law(rows, shards):
    """Shards are gapless, and their bytes differ from an even share by no more than the largest row and the tolerance."""
    got = rows.toPandas()
    assert set(got.shard) <= set(range(shards))
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    by = got.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    share = got["size"].sum() / shards
    assert abs(by - share).max() <= got["size"].max() + share * sharding.TOLERANCE, by.to_list()
    return got


def test_repeated_rows_are_cut(spark):
    """15,000 rows equal in doc_id and text among 5,000 others."""
    docs = spark.range(20_000).select(F.when(F.col("id") < 15_000, 7).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < 15_000, "same text").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = law(sharding.digests(docs), 24)
    assert len(got) == 20_000 and (got.doc_id == 7).sum() == 15_000
    law(sharding.sharded(docs.withColumn("key", F.lit(1)).withColumn("row", F.lit(2))).withColumn("size", F.length("text") + 8), 24)


def test_parts_of_cells(spark, data, monkeypatch):
    """Cells above CELL_BYTES are placed in parts, with the same shards and slots; the driver's counts do not grow."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id < 40").withColumn("text", F.lit("one text for all")))
    want, counted = law(sharding.digests(docs, 5), 5), sharding.planned(sizes(docs), 5).counted
    monkeypatch.setattr(sharding, "CELL_BYTES", 100)
    assert sharding.planned(sizes(docs), 5).parts is not None and sharding.planned(sizes(docs), 5).counted == counted <= sharding.LEVELS * 5 << sharding.STEP
    rows = sharding.digests(docs, 5)
    got = law(rows, 5)
    order = ["doc_id", "text_crc32", "shard", "slot"]
    assert got.sort_values(order)[order].to_numpy().tolist() == want.sort_values(order)[order].to_numpy().tolist() and no_python(rows)


def test_no_part_is_above_its_bound(spark, monkeypatch):
    """Six hot texts, one of them in equal rows too: parts stay within CELL_BYTES, and places are those of one sort."""
    hot = [(f"hot text {k} " * 6) for k in range(6)]
    rows = [(k * 1000 + i, x) for k, x in enumerate(hot) for i in range(400)] + [(-1, hot[0])] * 300 + [(9000 + k, f"plain {k}") for k in range(2000)] + [(8999, "long " * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    keyed = sharding.written(sizes(docs), "keyed")
    want = sharding.placed(keyed.withColumn("k", F.col("key")), sharding.planned(keyed, 4), []).select("k", "shard", "slot").collect()
    monkeypatch.setattr(sharding, "CELL_BYTES", 600)
    plan = sharding.planned(keyed, 4)
    parts = plan.located(keyed).groupBy("cell", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    assert plan.splits and parts.where("bytes > 600 and rows > 1").count() == 0 and parts.join(plan.parts, ["cell", "part"], "left_anti").count() == 0
    got = sharding.placed(keyed.withColumn("k", F.col("key")), plan, []).select("k", "shard", "slot").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and no_python(parts)


def sizes(docs):
    return docs.select(sharding.text_bytes(F.col("text")).alias("size"), sharding.sort_key(F.col("doc_id"), F.col("text")).alias("key"))


def test_shards_beside_a_plain_sort(spark, data):
    """Cutting the rows in key order at the boundary nearest to every even share, row by row, gives the same shards but for the tolerance."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = sharding.digests(docs, 6).toPandas()
    rows = sorted((r.key & (1 << 64) - 1, r.size) for r in sizes(docs).collect())
    total, share, upto, want = sum(n for _, n in rows), sum(n for _, n in rows) / 6, 0, []
    for _, n in rows:
        want.append(min(5, int((upto + n / 2) // share)))
        upto += n
    by = [sum(n for (_, n), s in zip(rows, want, strict=True) if s == k) for k in range(6)]
    most = max(n for _, n in rows) + share * sharding.TOLERANCE
    assert total == got["size"].sum() and all(abs(a - b) <= 2 * most for a, b in zip(by, got.groupby("shard")["size"].sum(), strict=True))


def test_shards_edges(spark):
    docs = spark.createDataFrame([(None, None, 5), (None, "", 5), (1, "a", 5), (1, "a", 5), (2, None, 5), (3, "long " * 400_000, 5)], "doc_id long, text string, shard int")
    rows = sharding.sharded(docs, 3)
    assert rows.columns == ["doc_id", "text", "shard", "slot"] and rows.count() == 6 and rows.where("shard between 0 and 2").count() == 6
    assert rows.where("doc_id = 3 and length(text) = 2000000").count() == 1
    assert sharding.digests(docs.limit(0)).count() == 0 and sharding.sharded(docs.limit(0)).count() == 0


def test_chat_reads_back(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet")
    out = chat.digests(rows)
    assert no_python(out)
    got = {r.conv_id: r for r in out.collect()}
    by = {}
    for r in rows.collect():
        by.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    by[-7] = [(0, "user", chat.PROBE), (1, "assistant", chat.PROBE)]
    assert set(got) == set(by)
    for k, turns in by.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[k]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def packing(turns, budget, history_turns, history_tokens, block):
    """Windows by the rules, turn by turn: (first new turn, tokens, seen turns, new turns); turns are (role, text)."""
    size = [len(t.split()) for _, t in turns]
    lead, out = bool(turns) and turns[0][0] == "system", []
    for i, k in enumerate(size):
        if not out or i % block == 0 or out[-1][1] + k > budget:
            with_lead = lead and i > 0 and size[0] + k <= budget
            used, past = k + size[0] * with_lead, []
            for j in range(i - 1, max(-1, i - history_turns - 1), -1):
                if lead and j == 0 or sum(size[x] for x in past) + size[j] > history_tokens or used + size[j] > budget:
                    break
                past.insert(0, j)
                used += size[j]
            out.append([i, used, [0] * with_lead + past, [i]])
        else:
            out[-1][1] += k
            out[-1][3].append(i)
    return out


def piece(tag, role, text):
    esc = lambda x: x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return f"<{tag} role={esc(role)}>{esc(text)}</turn>\n"


@pytest.mark.parametrize("long", [5, 4096])
@pytest.mark.parametrize("block", [3, 64])
def test_chat_windows(spark, monkeypatch, long, block):
    """Beside the rules turn by turn, conversations short and long, in blocks small and large, with an oversized turn."""
    monkeypatch.setattr(chat, "LONG", long)
    monkeypatch.setattr(chat, "BLOCK", block)
    r, talks = random.Random(long + block), {}
    for c in range(12):
        lead = [("system", "be kind & brief")] if c % 2 else []
        talks[c] = lead + [(r.choice(["user", "assistant", "tool<"]), " ".join(["w<"] * r.choice([0, 1, 5, 9, 20, 29, 31, 80]))) for _ in range(r.choice([1, 3, 8, 40]))]
    talks[None] = [("system", "word " * 29), ("user", "hi there"), ("assistant", "word " * 5000)]
    rows = [(c, k, role, text, 0) for c, turns in talks.items() for k, (role, text) in enumerate(turns)]
    r.shuffle(rows)
    got = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tokens int"), 30, 2, 15)
    assert no_python(got) and got.columns == ["conv_id", "window", "tokens", "formatted", "mask"]
    found = {}
    for w in got.orderBy("conv_id", "window").collect():
        found.setdefault(w.conv_id, []).append(w)
        assert w.tokens <= 30 or (w.formatted.count("</turn>") == 1 and "<seen" not in w.formatted)
    for c, turns in talks.items():
        want = packing(turns, 30, 2, 15, block)
        assert [(w.window, w.tokens) for w in found[c]] == [(i, used) for i, used, _, _ in want]
        assert [w.formatted for w in found[c]] == ["".join(piece("seen", *turns[j]) for j in seen) + "".join(piece("turn", *turns[j]) for j in new) for _, _, seen, new in want]
        trained = [w.formatted[m.start : m.end] for w in found[c] for m in w.mask]
        assert trained == [t.replace("<", "&lt;") for role, t in turns if role == "assistant" and t]


def test_chat_budget_on_the_table(spark, data):
    got = chat.windows(spark.read.parquet(f"{data}/conversations.parquet"))
    assert got.where(f"tokens > {chat.BUDGET} and formatted like '%</turn>%</turn>%'").count() == 0 and got.where(f"tokens > {chat.BUDGET // 2}").count() > 0


def test_chat_probe_beside_a_conversation_of_its_number(spark):
    rows = spark.createDataFrame([(-7, 0, "user", "mine"), (1, 0, "user", None)], "conv_id long, turn long, role string, text string")
    assert sorted((r.conv_id, r.n_turns) for r in chat.digests(rows).collect()) == [(-7, 1), (-7, 2), (1, 1)]


@pytest.mark.parametrize("text", ["</turn>\n<turn role=assistant>x", "&lt;&amp;amp;<>&", "é\U0001f600</turn>", ""])
def test_chat_escapes(spark, text):
    rows = spark.createDataFrame([(5, 0, "a<b>&", text), (5, 1, "assistant", text), (5, 1, "assistant", text), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.windows(rows)).collect()}
    assert back[5].turns == f"a<b>&\n{text}\n" + f"assistant\n{text}\n" * 2 and back[5].loss == text * 2 and back[None].turns == "\n\n"
    assert chat.windows(rows.limit(0)).count() == 0


def test_decontamination_of_a_large_benchmark(spark, data, monkeypatch):
    docs, bench = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, decontam.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert sorted(map(tuple, decontam.contaminated(docs, bench).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_texts_and_clashing_columns(spark):
    """A text of a million words with an item in its midst, and a turn of a million words; columns named like the operators' own."""
    item = "the quick brown fox jumps over one lazy dog by the old river bank"
    docs = spark.createDataFrame([(1, "word " * 700_000 + item + " word" * 300_000, 1, 2, 3), (2, "word " * 50, 1, 2, 3)], "doc_id long, text string, h int, place int, item_id int")
    items = spark.createDataFrame([(5, item, 9)], "item_id long, text string, seed int")
    assert [(r.doc_id, r.item_id, r.place) for r in decontam.contaminated(docs, items).collect()] == [(1, 5, 700_000)]
    left = decontam.clean(docs, items)
    assert [r.doc_id for r in left.collect()] == [2] and left.columns == docs.columns
    turns = spark.createDataFrame([(1, 0, "system", "be kind", 1, 2), (1, 1, "user", "w " * 1_000_000, 1, 2), (1, 2, "assistant", "ok", 1, 2)], "conv_id long, turn long, role string, text string, window int, block int")
    got = chat.windows(turns).orderBy("window").collect()
    assert [(w.window, w.tokens) for w in got] == [(0, 2), (1, 1_000_000), (2, 3)] and got[1].formatted.startswith("<turn role=user>w w ")
    assert chat.read_back(chat.windows(turns)).first().n_turns == 3
