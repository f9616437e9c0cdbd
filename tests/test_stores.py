"""What is kept between runs, and terms filed under their rarest gram."""

import os
import random

from pyspark.sql import functions as F

from lectern.operators import catalog, stores

PATTERN = r"https://[a-z0-9.]+"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, text string")


def test_two_harvests_and_no_exchange_of_what_was_seen(spark):
    store = stores.SeenStore(spark, buckets=4)
    one = pages(spark, [(1, "https://a.x https://b.x https://a.x"), (2, "https://b.x"), (3, None)])
    two = pages(spark, [(4, "https://b.x https://c.x"), (5, "https://c.x https://a.x"), (6, "")])
    got = store.harvest(one, "text", "page_id", PATTERN)
    assert sorted(tuple(r) for r in got.collect()) == [("https://a.x", 1, 0, 1), ("https://b.x", 1, 1, 2)]
    new = store.new(two.select(F.explode(F.split("text", " ")).alias("url")))
    plan = new._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    seen_side = plan[: plan.index("FileScan parquet")].splitlines()[-6:]
    assert "Bucketed: true" in plan and not any("Exchange" in line for line in seen_side)
    assert sorted(tuple(r) for r in store.harvest(two, "text", "page_id", PATTERN).collect()) == [("https://c.x", 4, 1, 2)]
    assert store.harvest(one.unionByName(two), "text", "page_id", PATTERN).count() == 0
    assert store.harvest(one.limit(0), "text", "page_id", PATTERN).count() == 0
    small = store.compact()
    assert sorted(r.url for r in small.table().collect()) == sorted(r.url for r in store.table().collect()) == ["https://a.x", "https://b.x", "https://c.x"]
    again = stores.SeenStore(spark, store.path, buckets=4)
    assert again.table().count() == 3
    for s in (store, small, again):
        s.close()


def files(path):
    return {os.path.join(f, x): os.stat(os.path.join(f, x)).st_mtime_ns for f, _, names in os.walk(path) for x in names if x.endswith(".parquet")}


def test_a_batch_rewrites_the_buckets_it_touches(spark):
    schema = "topic_id long, stream string, status string, video_url string, completed_at timestamp"
    topics = spark.createDataFrame([(i, "s", "Pending", None, None) for i in range(200)], schema)
    store = stores.SnapshotStore(spark, buckets=32).create(topics)
    before = files(store.path)
    rows = [(3, "Completed", 5, "u3", 1), (3, "Failed", 4, None, 2), (9_999, "Failed", 4, None, 3), (9_999, "Failed", 6, None, 4)]
    events = spark.createDataFrame(rows, "topic_id long, status string, at long, video_url string, event_id long").withColumn("ts", F.timestamp_seconds("at"))
    rejected = store.apply(events)
    assert sorted(r.event_id for r in rejected.collect()) == [3, 4] and rejected.columns == events.columns
    after = files(store.path)
    changed = {os.path.dirname(f) for f in set(before) ^ set(after)}
    assert 1 <= len(changed) <= 2 and len({os.path.dirname(f) for f in after}) >= 20
    full = catalog.apply_status(topics, events)
    assert sorted(map(str, store.topics().select(*full.columns).collect())) == sorted(map(str, full.collect()))
    assert store.apply(events.limit(0)).count() == 0 and files(store.path) == after


def shuffled_records(spark):
    sc = spark.sparkContext
    none, empty = sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList()
    return sum(s.shuffleWriteRecords() for s in sc._jvm.scala.jdk.javaapi.CollectionConverters.asJava(sc._jsc.sc().statusStore().stageList(None, False, False, none, empty)))


def test_events_move_once_in_a_batch(spark):
    topics = spark.range(20_000).selectExpr("id AS topic_id", "'s' AS stream", "'Pending' AS status", "cast(null AS string) AS video_url", "cast(null AS timestamp) AS completed_at")
    store = stores.SnapshotStore(spark, buckets=4).create(topics)
    ids = "CASE WHEN id = 7 THEN null WHEN id < 20 THEN 100000 ELSE id DIV 10 END"
    events = spark.range(200_000).selectExpr(f"{ids} AS topic_id", "'Completed' AS status", "'u' AS video_url", "id AS event_id", "timestamp_seconds(id) AS ts")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        before = shuffled_records(spark)
        rejected = store.apply(events)
        moved = shuffled_records(spark) - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(r.event_id for r in rejected.collect()) == list(range(20))
    assert store.topics().where("status = 'Completed' AND video_url = 'u' AND completed_at = timestamp_seconds(topic_id * 10 + 9)").count() == 19_998
    assert moved < 100_000  # the topics twice and one event each, not all events


def test_two_runs_never_claim_one_topic(spark):
    rows = [(i, stream, i % 2, "Pending" if i != 4 else "Failed") for i, stream in enumerate(["a"] * 5 + ["b"] * 2 + ["c"])]
    topics = spark.createDataFrame(rows, "topic_id long, stream string, created_time long, status string")
    one = stores.ClaimLedger(spark)
    two = stores.ClaimLedger(spark, one.path)
    assert one.entries().count() == 0
    # the second run takes a topic after the first has read its own choice
    take = one._take

    def slow(topic, run):
        one._take = take
        assert two.claim(topics, "two", ["a"]) == {"a": "0"}
        return take(topic, run)

    one._take = slow
    assert one.claim(topics, "one") == {"a": "2", "b": "6", "c": "7"}
    assert two.claim(topics, "two") == {"a": "1", "b": "5"}
    assert not take("7", "three")
    assert sorted((r.topic_id, r.run) for r in one.entries().collect()) == [("0", "two"), ("1", "two"), ("2", "one"), ("5", "two"), ("6", "one"), ("7", "one")]
    status = {r.topic_id: r.status for r in one.snapshot(topics).collect()}
    assert status == {0: "In Progress", 1: "In Progress", 2: "In Progress", 3: "Pending", 4: "Failed", 5: "In Progress", 6: "In Progress", 7: "In Progress"}


def test_terms_that_begin_alike_meet_few_topics(spark):
    r = random.Random(4)
    names = [f"introduction to {''.join(r.choices('abcdefghij', k=10))}" for _ in range(3_000)]
    wanted = r.sample(names, 40)
    terms = wanted + [f"introduction to {''.join(r.choices('abcdefghij', k=10))}" for _ in range(10_000)] + ["introduction to zz"]
    topics = spark.createDataFrame(list(enumerate(names)), "topic_id long, topic string")
    t = spark.createDataFrame([(x,) for x in terms], "term string")
    pairs = catalog.term_candidates(topics, t).count()
    assert pairs < 10_000  # of 30 million; a common first piece would give all of them
    got = {x.topic for x in catalog.find_topics_by_terms(topics, t).collect()}
    assert got == {n for n in names if any(x in n for x in set(terms) & set(names))} and set(wanted) <= got


def test_terms_are_sent_to_topics_and_not_topics_to_terms(spark):
    topics = spark.range(500).selectExpr("id AS topic_id", "concat('a long title of topic ', id) AS topic")
    terms = topics.selectExpr("substr(topic, 15, 9) AS term").unionByName(spark.range(50).selectExpr("concat('none ', id) AS term"))
    pairs = catalog.term_candidates(topics, terms)
    assert pairs.where("topic LIKE concat('%', term, '%')").select("topic_id").distinct().count() == 500
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan


def test_short_odd_and_missing_terms(spark):
    names = ["abc", "ab", "a", "", None, "xabcdx", "ABC", "b c", "üöä end"]
    topics = spark.createDataFrame(list(enumerate(names)), "topic_id long, topic string")
    for terms in (["a"], ["ab", "zz"], ["abcd"], ["abcdx", "b c"], ["öä e"], ["", None], [], ["q"], ["xabcdx", "a", "ab", "abc"]):
        t = spark.createDataFrame([(x,) for x in terms], "term string")
        want = {n for n in names if n is not None and any(x and x in n for x in terms)}
        assert {x.topic for x in catalog.find_topics_by_terms(topics, t).collect()} == want, terms
