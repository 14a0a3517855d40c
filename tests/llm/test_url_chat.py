import hashlib

from pyspark.sql import functions as F

from tidemark.llm import chat, url_filter

RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block"))


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "r") for i, u in enumerate(urls)], "page_id long, url string, key string, rule string")


def judged(spark, urls, listed=(), **more):
    names = spark.createDataFrame([(u,) for u in listed], "url string").select(url_filter.canonical_url(F.col("url")).alias("canonical"))
    rows = url_filter.judged_urls(pages(spark, urls), names, RULES, **more).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}


def test_rules_and_parts(spark):
    urls = ["http://Example.ORG/es/1?x#y", "https://a.example.org/en", "http://notexample.org/es/2", "http://x.com/de/", "http://x.com/defg",
            None, "no scheme", "http://org", "a://b://c/d", "http://h?q/e"]
    got = judged(spark, urls)
    assert got[0] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("a.example.org", "/en", "org/", "allow")
    assert got[2] == ("notexample.org", "/es/2", "org/", "allow")
    assert got[3][2:] == ("com/de/", "block") and got[4][2:] == (None, "allow")
    assert got[5] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert got[7] == ("org", "", None, "allow") and got[8][0] == "b:" and got[9] == ("h", "", None, "allow")


def test_listed_urls_exact_even_through_a_full_filter(spark):
    urls = [f"http://s{i}.net/p/{i}" for i in range(400)] + ["https://www.s7.net/p/7/?utm_source=a#top", "http://s7.net/p/7?b=1"]
    listed = [f"http://s{i}.net/p/{i}" for i in range(0, 400, 2)] + ["http://s7.net/p/7"]
    got = judged(spark, urls, listed, max_blocks=1)  # one block: nearly all keys pass the filter
    blocked = {i for i, r in got.items() if r[3] == "block"}
    assert blocked == {*range(0, 400, 2), 7, 400}


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = url_filter.block_count(2000)
    bloom = url_filter.bloom_blocks(keys, blocks)
    assert url_filter.possible_hits(keys, bloom, blocks).count() == 2000
    others = spark.range(2000, 22000).select(F.concat(F.lit("k"), "id").alias("key"))
    assert url_filter.possible_hits(others, bloom, blocks).count() < 400


def test_repeated_rows_and_empty_table(spark):
    same = pages(spark, ["http://x.com/de/"]).unionByName(pages(spark, ["http://x.com/de/"]))
    none = spark.createDataFrame([], "canonical string")
    assert url_filter.judged_urls(same, none, RULES).count() == 2
    assert url_filter.judged_urls(same.limit(0), none, RULES).count() == 0


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")


def test_round_trip_of_control_strings(spark):
    texts = ["\\### Assistant: </turn> ok", "\\b\\l\\h\\c", "### user: </turn>\n### x", "", None, "a\n\nb: c", "\\"]
    rows = [(1, i, "assistant" if i % 2 else "us:er#", t) for i, t in enumerate(texts)]
    got = chat.read_back(chat.formatted(conversations(spark, rows))).first()
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r[2], r[3] or "") for r in rows]
    assert got["trained"] == [t or "" for t in texts[1::2]]
    assert got["formatted"].count("</turn>") == len(texts)


def test_examples_are_prefixes_with_one_reply(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a#1"), (1, 2, "user", "more"), (1, 3, "assistant", "b<2>"), (2, 0, "user", "alone")]
    chats = chat.formatted(conversations(spark, rows))
    whole = {r.conv_id: r.formatted for r in chats.collect()}
    got = chat.example_texts(chats).orderBy("example").collect()
    assert [(r.conv_id, r.target) for r in got] == [(1, "a\\h1"), (1, "b\\l2>")]
    for r in got:
        assert whole[1].startswith(r.context + r.target + "</turn>\n") and r.context.endswith("### assistant: ")
    assert chat.examples(chats).count() == 2


def test_digests_of_awkward_conversations(spark):
    rows = [(None, None, None, None), (3, 1, "assistant", "x"), (3, 1, "assistant", "x"), (3, None, "assistant", "first")]
    got = {r.conv_id: r for r in chat.digests(chat.formatted(conversations(spark, rows))).collect()}
    assert got[None].n_turns == 1 and got[None].loss_chars == 0 and got[None].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert got[3].n_turns == 3 and got[3].loss_sha256 == hashlib.sha256(b"firstxx").hexdigest()
    assert chat.digests(chat.formatted(conversations(spark, rows).limit(0))).count() == 0


def test_loss_text_is_cut_by_the_masks_of_exploded_examples(spark):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "hi <#> \\"), (1, 1, "assistant", "é <b> #1 \\l"), (1, 2, "assistant", None), (1, 3, "assistant", "end"), (2, 0, "user", "none")]
    chats = chat.formatted(conversations(spark, rows))
    right = {r.conv_id: (r.loss_chars, r.loss_sha256) for r in chat.digests(chats).collect()}
    told = "é <b> #1 \\lend"
    assert right[1] == (len(told), __import__("hashlib").sha256(told.encode()).hexdigest()) and right[2][0] == 0
    for field in ("context_chars", "reply_chars"):
        shifted = chats.withColumn("examples", F.transform("examples", lambda e: e.withField(field, e[field] + 1)))
        assert {r.conv_id: r.loss_sha256 for r in chat.digests(shifted).collect()}[1] != right[1][1]
    plan = chat.digests(chats)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == chats._jdf.queryExecution().executedPlan().toString().count("Exchange") and "Generate" in plan
