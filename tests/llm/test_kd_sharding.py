import zlib

from pyspark.sql import functions as F

from marquee.llm.kd_sharding import kd_shards, shard_report


def test_contract(documents, rows):
    got = shard_report(documents).collect()
    text = dict(rows)
    assert sorted(r.doc_id for r in got) == sorted(text)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert 0 <= r.shard < 16
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_even_bytes_and_whole_groups(workers):
    frame = workers.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("text "), F.pmod("id", F.lit(9_000)).cast("string"), F.repeat(F.lit("é\n"), F.pmod("id", F.lit(30)).cast("int"))).alias("text"))
    got = kd_shards(frame).toPandas()
    weight = got.groupby("shard")["size"].sum()
    assert len(weight) == 16
    assert weight.max() <= 1.03 * weight.mean() and weight.min() >= 0.97 * weight.mean()


def test_hot_group_is_cut_small_ones_are_not(workers):
    hot = workers.range(4_000).select("id", F.lit("the very same text in a third of all rows").alias("text"))
    rest = workers.range(4_000, 12_000).select("id", F.concat(F.lit("own text number "), F.floor(F.col("id") / 2).cast("string")).alias("text"))
    got = kd_shards(hot.union(rest).withColumnRenamed("id", "doc_id")).toPandas()
    weight = got.groupby("shard")["size"].sum()
    assert weight.max() <= 1.05 * weight.mean() and weight.min() >= 0.95 * weight.mean()
    groups = got[got.doc_id >= 4_000].groupby(["text_crc32", "size"]).shard.nunique()
    assert (groups == 1).all()


def test_other_counts_and_target(documents):
    for n in (1, 3, 5):
        got = kd_shards(documents, n_shards=n).toPandas()
        assert set(got.shard) <= set(range(n))
    total = kd_shards(documents).agg(F.sum("size")).first()[0]
    assert kd_shards(documents, target_bytes=total // 4 + 1).agg(F.max("shard")).first()[0] == 3


def test_shapes(empty, clashing, with_nulls):
    assert shard_report(empty).count() == 0
    assert shard_report(clashing).count() == clashing.count()
    got = shard_report(with_nulls).toPandas()
    assert len(got) == with_nulls.count()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_hot_identical_rows_and_carried_texts(workers):
    """Rows alike get slots of their own, and every row comes with its text."""
    alike = workers.range(3_000).selectExpr("cast(7 as long) as doc_id", "'the same row' as text", "'s' as source")
    rest = workers.range(3_000).selectExpr("if(id % 2 = 0, null, id) as doc_id", "concat('text ', id) as text", "'t' as source")
    docs = alike.union(rest)
    got = kd_shards(docs, n_shards=4, carry=("text", "source")).toPandas()
    assert len(got) == 6_000
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert [zlib.crc32(t.encode()) for t in got.text] == list(got.text_crc32)
    assert (got[got.source == "s"].doc_id == 7).all() and got[got.source == "t"].text.nunique() == 3_000


def brute_leaves(points, k):
    """The tree on (scaled dimensions, crc, size) rows, in plain Python: shard of every row."""
    def grow(rows, k, first):
        if k == 1 or not rows:
            return {r: first for r in rows}
        n = len(points[rows[0]][0])
        widest = max(range(n), key=lambda i: (max(points[r][0][i] for r in rows) - min(points[r][0][i] for r in rows), -i))
        groups = {}
        for r in rows:
            groups.setdefault((points[r][0][widest], points[r][1]), []).append(r)
        total = sum(points[r][2] for r in rows)
        aim, run, left = total * (k // 2) / k, 0, []
        for key in sorted(groups):
            weight = sum(points[r][2] for r in groups[key])
            if run + weight > aim or key == max(groups):
                if run + weight - aim <= aim - run:
                    left += groups[key]
                break
            run += weight
            left += groups[key]
        right = [r for r in rows if r not in set(left)]
        return grow(left, k // 2, first) | grow(right, k - k // 2, first + k // 2)

    return grow(sorted(points), k, 0)


def test_leaves_match_brute_force(workers):
    """Own texts of metadata that differ: every row in the leaf that a plain tree gives it."""
    rows = [(i, ("wort " * (i % 7 + 1) + "é" * (i % 5) + "\n" * (i % 3) + f"t{i}") * (i % 4 + 1), ["de", "en", "fr", None][i % 4],
             f"s{i * 7 % 11}") for i in range(900)]
    docs = workers.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)

    def place(name):
        return float(int((name or "").encode()[:6].hex().ljust(12, "0"), 16)) if name else None

    raw = {}
    for d, t, lang, source in rows:
        raw[d] = [len(t.encode()) / len(t), t.count("\n") / len(t), t.count(" ") / len(t), place(lang), place(source)]
    low = [min(r[i] for r in raw.values() if r[i] is not None) for i in range(5)]
    high = [max(r[i] for r in raw.values() if r[i] is not None) for i in range(5)]
    top = (1 << 20) - 1
    points = {}
    for d, t, _, _ in rows:
        q = [0 if raw[d][i] is None else int((raw[d][i] - low[i]) * (top / (high[i] - low[i]))) for i in range(5)]
        points[d] = (q, zlib.crc32(t.encode()), len(t.encode()) + 1)
    got = {r.doc_id: r.shard for r in kd_shards(docs, n_shards=8, tolerance=1.0).collect()}
    assert got == brute_leaves(points, 8)


def test_equal_texts_of_many_sources_share_a_shard(workers):
    docs = workers.range(6_000).selectExpr(
        "id as doc_id", "concat('text ', id div 3) as text", "array('de', 'en', null)[id % 3] as lang", "concat('s', id % 13) as source")
    got = kd_shards(docs).toPandas()
    got["text"] = got.doc_id // 3
    assert (got.groupby("text").shard.nunique() == 1).all()
    weight = got.groupby("shard")["size"].sum()
    assert weight.max() <= 1.03 * weight.mean() and weight.min() >= 0.97 * weight.mean()
