"""Each operator against a plain version on whole small tables, and its defined results on odd rows."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pursefold.llm import components, decontaminate, lines, packing, quality_rank, quality_rules, queries, simhash, substring, toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def table(spark, name="documents", folder=SF):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=str)


def plain(df, *columns):
    return ordered(tuple(r) for r in df.select(*columns).collect())


SIMHASH = ("doc_id", "fingerprint", "component_id")
SUBSTRING = ("doc_id", "n_words", "n_removed", "kept_sha256")
BENCHMARK = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_simhash_on_documents(spark):
    assert plain(queries.op1_simhash(spark, SF), *SIMHASH) == ordered(brute.simhash(texts(table(spark))))


def test_simhash_on_odd_rows(spark, odd):
    assert plain(simhash.classes(odd), *SIMHASH) == ordered(brute.simhash(texts(odd)))
    assert simhash.classes(odd.filter("false")).count() == 0


def test_one_document_of_each_class_stays(spark, odd):
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    prints = [(i, brute.fingerprint(t)) for i, t in texts(odd)]
    found = brute.roots(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    # One row for each class, also where two classes have the same least id.
    assert ordered(r.doc_id for r in kept.collect()) == ordered(brute.least_of(prints, found).values())


def test_classes_that_share_an_id_or_have_none_keep_a_row_each(spark):
    def text(k, n=40):
        return " ".join(f"t{k}w{j}" for j in range(n))

    rows = [(None, text(k)) for k in range(5)] + [(None, text(0))] * 2  # five classes without an id, one of three rows
    rows += [(7, text(k)) for k in range(5, 8)] + [(7, text(5))]  # three classes named 7, one with a repeated row
    rows += [(8, text(6)), (9, text(9)), (7, text(9)), (3, text(9))]  # 7 has rows in the classes named 7 and 3
    rows += [(None, text(11)), (12, text(11))]  # an id goes before none
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in simhash.representatives(docs).collect()]
    wanted = [(None, text(k)) for k in range(5)] + [(7, text(k)) for k in range(5, 8)] + [(3, text(9)), (12, text(11))]
    assert ordered(kept) == ordered(wanted)
    assert simhash.representatives(docs.filter("false")).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("tree_size", [4, 1024])
def test_links_have_the_components_of_all_pairs(spark, radius, tree_size):
    random = np.random.default_rng(radius)
    values = {0}
    for base in random.integers(0, 2**63, 12):
        for _ in range(15):
            flips = random.choice(64, random.integers(0, radius + 2), replace=False)
            values.add(int(base) ^ sum(1 << int(b) for b in flips))
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius, tree_size)
    roots = {r.node: r.root for r in components.components(found).collect()}
    wanted = brute.components(list(zip(signed, values)), lambda a, b: (a ^ b).bit_count() <= radius)
    assert [roots.get(v, v) for v in signed] == wanted


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(k, k + 1) for k in range(40)]
    hub = [(1000, 1000 + k) for k in range(1, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain + hub + [(5, 5)], "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(1000, 1200), 1000)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tree_finds_what_comparing_all_finds():
    random = np.random.default_rng(1)
    values = [int(v) for v in random.integers(0, 256, 100)]
    tree = simhash.Tree()
    for v in values:
        tree.add(v)
    for q in range(256):
        assert {tree.values[k] for k in tree.near(q, 2)} == {v for v in values if (v ^ q).bit_count() <= 2}


def unpacked(df):
    """Ids of each document from its pieces, after the rules of packing have been checked."""
    rows = df.collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return by_doc, len(by_sequence), sum(r.length for r in rows)


def tokens(text, tokenizer, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_packing_of_documents(spark):
    by_doc, n, total = unpacked(queries.op2_packing(spark, SF))
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    docs = texts(table(spark))
    assert len(by_doc) == len(docs)
    for id, text in docs:
        ids = tokens(text, tokenizer, 1)
        at = 0
        for r in sorted(by_doc[id, len(ids)], key=lambda r: r.start):
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert n <= total / 2048 * 1.04 + 1


def test_packing_of_odd_rows(spark, odd):
    rows = packing.pieces(odd, BYTES)
    done = packing.packed(rows)
    by_doc, _, total = unpacked(done)
    assert total == rows.agg({"length": "sum"}).first()[0]
    assert len(by_doc[5, by_doc_tokens(by_doc, 5)]) == 2  # a repeated row is packed twice
    whole = {r.sequence_id: r.ids for r in packing.sequences(done).collect()}
    for r in done.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    assert packing.packed(packing.pieces(odd.filter("false"), BYTES)).count() == 0


def by_doc_tokens(by_doc, id):
    return next(n for i, n in by_doc if i == id)


def test_patterns_cover_every_piece():
    random = np.random.default_rng(5)
    for _ in range(5):
        demand = {int(w): int(n) for w, n in zip(random.integers(1, 65, 20), random.integers(1, 500, 20))}
        plan = packing.patterns(demand, 64)
        assert all(sum(w * n for w, n in p.items()) <= 64 for p, _ in plan)
        assert all(sum(p.get(w, 0) * t for p, t in plan) >= n for w, n in demand.items())
        rooms = []
        for w in sorted((w for w, n in demand.items() for _ in range(n)), reverse=True):  # first fit by falling width
            k = next((k for k, room in enumerate(rooms) if room >= w), None)
            if k is None:
                rooms.append(64 - w)
            else:
                rooms[k] -= w
        assert sum(t for _, t in plan) <= len(rooms) * 1.01 + 2
    assert packing.patterns({}, 64) == []


def test_rule_counts(spark, odd):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for docs in (table(spark), odd):
        assert plain(quality_rules.verdicts(docs), *columns) == ordered((i, *brute.base_counts(t)) for i, t in texts(docs))
    assert quality_rules.verdicts(odd.filter("false")).count() == 0


def test_rule_verdicts_follow_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op3_quality_rules(spark, folder).join(table(spark, "labels", folder), "doc_id").toPandas()
    assert not (found.kept & found.base_failed).any()
    sound = found[~found.base_failed]
    assert (sound.kept == (sound.quality == 1)).mean() > 0.98


def test_fences_follow_the_group_and_fall_back(spark):
    def row(source, symbols, k):
        return (f"{source}{k}", " ".join(f"w{source}{j}x{k}" + ("#" if j < symbols else "") for j in range(100)), "en", source)

    rows = [row("plain", 0, k) for k in range(300)] + [row("tags", 60 + k % 5, k) for k in range(300)] + [row("tiny", 60, 1)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.verdicts(docs).filter("kept").collect()}
    assert len(kept) == 601  # the language's spread covers both kinds
    alone = spark.createDataFrame([*rows[:300], ("odd", rows[300][1], "en", "plain")], docs.schema)
    assert {r.doc_id for r in quality_rules.verdicts(alone).filter("not kept").collect()} == {"odd"}


def test_sources_of_other_spreads_judge_alike_texts_otherwise(spark):
    """The same repetitive text is odd where nothing repeats and usual where much does."""
    def row(id, source, again):
        words = [f"w{id}x{j}" for j in range(100)]
        words[50 : 50 + again] = words[:again]
        return id, " ".join(words), "en", source

    rows = [row(f"a{k}", "plain", 0) for k in range(400)] + [row(f"b{k}", "forms", 3 * (k % 9)) for k in range(400)]
    same = row("same", "", 12)[1]
    docs = spark.createDataFrame([*rows, ("in plain", same, "en", "plain"), ("in forms", same, "en", "forms")], "doc_id string, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.verdicts(docs).collect()}
    assert not kept["in plain"] and kept["in forms"]
    assert sum(kept.values()) >= 0.98 * len(kept)
    stats = quality_rules.with_stats(docs, keep_text=False)
    cuts = {r["__source"]: r.hi_repeats for r in quality_rules.fences(stats).collect()}
    assert cuts["plain"] < 240 < cuts["forms"]


def test_decontamination(spark, odd):
    items = table(spark, "benchmark")
    benchmark = [(r.item_id, r.text) for r in items.collect()]
    assert plain(queries.op5_decontamination(spark, SF), *BENCHMARK) == ordered(brute.decontamination(texts(table(spark)), benchmark))
    few = spark.createDataFrame([(1, "One, two"), (2, None), (3, "word5 AND5 word6 and6 word7 and7 word8 and8 word9 and9 word10 and10 word11 and11"), (4, "three"), (5, "a b c d e a b c d e a b c"), (6, "one two three"), (7, "one two three")], "item_id long, text string")
    wanted = ordered(brute.decontamination(texts(odd), [(r.item_id, r.text) for r in few.collect()]))
    for limit in (10**6, 0):  # windows sent to all tasks, and joined by shuffle
        found = decontaminate.SENT_BYTES
        decontaminate.SENT_BYTES = limit
        try:
            got = decontaminate.judged(odd, few).collect()
        finally:
            decontaminate.SENT_BYTES = found
        assert ordered((r.doc_id, r.n_words, r.n_hit, len(r.item_ids), hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), r.contaminated) for r in got) == wanted
    none = decontaminate.judged(odd, few.filter("false"))
    assert none.count() == odd.count() and none.filter("contaminated").count() == 0
    assert decontaminate.judged(odd.filter("false"), few).count() == 0
    clean = decontaminate.clean(odd, few)
    assert clean.columns == odd.columns and clean.count() == sum(not r[-1] for r in wanted)


def test_a_window_that_many_items_share(spark):
    shared = " ".join(f"s{k}" for k in range(13))
    items = spark.range(100_000).selectExpr("id item_id", f"'{shared}' text")
    docs = spark.createDataFrame([(1, f"a {shared} b"), (2, "nothing of it"), (3, shared)], "doc_id long, text string")
    parts, owners = decontaminate.windows(items)
    assert parts.count() == 1 and owners.count() == 100_000
    got = {r.doc_id: r for r in decontaminate.judged(docs, items).collect()}
    wanted = sorted(map(str, range(100_000)))
    assert got[1].item_ids == got[3].item_ids == wanted and got[2].item_ids == []
    assert (got[1].n_hit, got[3].n_hit, got[1].contaminated) == (13, 13, True)


def test_items_without_an_id_hit_but_are_not_listed(spark):
    items = spark.createDataFrame([(None, "one two three"), (4, "three four")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "one two three"), (2, "one two three four")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_hit, r.item_ids, r.contaminated) for r in decontaminate.judged(docs, items).collect())
    assert got == [(1, 3, [], True), (2, 4, ["4"], True)]


def test_columns_of_the_operators_own_names_are_kept(spark):
    names = ("__hash", "__id", "__least", "__many", "__own", "__bad", "__stats", "__kept", "__base_failed", "__lang", "__source", "own3hash")
    docs = table(spark).limit(30).withColumns({n: F.concat(F.lit(n), "doc_id") for n in names})
    items = table(spark, "benchmark")
    for kept in (simhash.representatives(docs), decontaminate.clean(docs, items), quality_rules.accepted(docs)):
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


@pytest.mark.parametrize("radius, ranges", [(3, 4), (3, 5), (3, 6), (1, 3), (0, 2)])
def test_more_ranges_find_the_same_links(spark, radius, ranges):
    random = np.random.default_rng(9)
    values = sorted({int(b) ^ sum(1 << int(k) for k in random.choice(64, random.integers(0, radius + 2), replace=False)) for b in random.integers(0, 2**63, 10) for _ in range(12)})
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius, 4, ranges)
    roots = {r.node: r.root for r in components.components(found).collect()}
    wanted = brute.components(list(zip(signed, values)), lambda a, b: (a ^ b).bit_count() <= radius)
    assert [roots.get(v, v) for v in signed] == wanted


def test_copies_of_a_fingerprint_do_not_grow_with_their_number():
    copies = {n: len(simhash.shards(3, simhash.ranges_for(n, 3, 1024))) for n in (10**4, 10**5, 10**6, 10**7, 10**8, 10**9, 10**10)}
    assert copies == dict.fromkeys((10**4, 10**5, 10**6, 10**7), 4) | dict.fromkeys((10**8, 10**9, 10**10), 10)


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def split(spark):
    """No broadcasts, and partitions count as skewed early."""
    before = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hub_with_a_third_of_the_links_is_split(spark, split, monkeypatch):
    plans = []
    write = components.written

    def watched(df, name):
        df.agg(F.count("*")).collect()
        again = df.agg(F.count("*"))
        again.collect()
        plans.append(again._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(components, "written", watched)
    links = spark.range(0, 60_000, 1, 16).selectExpr("if(id % 3 = 0, -1, id * 7) a", "id * 7 + 1 b")
    found = components.components(links)
    assert found.filter("root = -1").count() == 20_001
    assert any("skew=true" in p for p in plans)


def test_substrings(spark, odd):
    assert plain(queries.op8_substring(spark, SF), *SUBSTRING) == ordered(brute.substrings(texts(table(spark))))
    distinct = odd.filter("doc_id is not null and not (doc_id = 10 and text like 'other%')").dropDuplicates(["doc_id"])
    got = ordered((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in substring.without_repeats(distinct).collect())
    assert got == ordered(brute.substrings(texts(distinct)))
    assert substring.without_repeats(odd).count() == odd.count()
    assert substring.without_repeats(odd.filter("false")).count() == 0


def test_substrings_between_blocks(spark, monkeypatch):
    """Every pair of alignments of a passage, each text a block of its own."""
    passage = [f"p{k}" for k in range(20)]
    rows = [(k, " ".join([f"x{k}_{j}" for j in range(k)] + passage + [f"y{k}"])) for k in range(14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(14)
    got = ordered((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in substring.without_repeats(docs).collect())
    assert got == ordered(brute.substrings(rows))
    assert sum(r[2] for r in got) == 13 * 20


def test_repeated_rows_are_no_repeats(spark):
    text = " ".join(f"w{k}" for k in range(50))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in substring.without_repeats(docs).collect()) == [(1, 0), (1, 0), (2, 50)]


def test_copies_of_a_text_keep_nothing(spark):
    text, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"w{k}" for k in range(25))
    rows = [(5, text), (3, text), (9, text), (4, other), (7, "few words"), (8, "few words"), (6, None), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ordered((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in substring.without_repeats(docs).collect())
    assert got == ordered(brute.substrings(rows))


def test_cover_has_every_difference():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


def test_lines(spark, odd):
    for docs, ratio, least in ((table(spark), 0.02, 3), (odd, 0.05, 1), (table(spark), 0.2, 2), (table(spark), 0.05, 2)):
        rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
        got = lines.cleaned(docs, "source", max_ratio=ratio, min_pages=least)
        assert plain(got, "doc_id", "__text", "__n_removed") == ordered(brute.kept_lines(rows, ratio, least))
    assert lines.cleaned(odd.filter("false"), "source").count() == 0


def test_lines_of_web_pages(spark):
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    pages = table(spark, "pages").withColumn("host", host)
    rows = [(r.page_id, r.host, r.html) for r in pages.collect()]
    got = lines.cleaned(pages, "host", id="page_id", text="html")
    assert plain(got, "page_id", "__text", "__n_removed") == ordered(brute.kept_lines(rows, lines.MAX_RATIO, lines.MIN_PAGES))


def test_small_hosts_and_pages_of_nothing_else_lose_boilerplate(spark):
    rows = [(k, "small", f"menu\nbody {k}\nfooter") for k in range(4)] + [(9, "small", "menu\nfooter")] + [(10, "other", "menu\nfooter")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r["__text"] for r in lines.cleaned(docs, "source").collect()}
    assert got == {k: f"body {k}" for k in range(4)} | {9: "", 10: "menu\nfooter"}


def test_a_line_on_three_pages_in_a_hundred_goes(spark):
    docs = spark.range(100).selectExpr("id doc_id", "'h' source", "concat(if(id < 3, 'menu\n', if(id < 5, 'twice\n', '')), 'own ', id) text")
    got = {r.doc_id: (r["__text"], r["__n_removed"]) for r in lines.cleaned(docs, "source").collect()}
    assert got == {k: (f"twice\nown {k}" if k in (3, 4) else f"own {k}", int(k < 3)) for k in range(100)}


def test_a_line_on_every_page_is_split(spark, split):
    """With broadcasts off, the hot line's rows are dealt to several tasks."""
    docs = spark.range(0, 20_000, 1, 16).selectExpr("id doc_id", "'h' source", "concat('footer\nown ', id) text")
    rows = lines.cleaned(docs, "source").agg(F.sum("__n_removed").alias("n"))
    assert rows.collect()[0].n == 20_000
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


def test_quality_scores_hold_on_unseen_rows(spark):
    folder = "/root/testdata/sf0.01"
    scores = queries.op9_quality(spark, folder)
    assert scores.count() == 1000
    found = scores.join(table(spark, "labels", folder), "doc_id").toPandas()
    unseen = found[found.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in found.itertuples())
    assert ((found.score >= 0.7) == (found.predicted == 1)).all() and found.score.between(0, 1).all()
    assert (unseen.predicted == unseen.quality).mean() > 0.95


def test_training_rows_do_not_depend_on_row_order(spark):
    docs = table(spark).unionByName(table(spark).limit(50).withColumn("text", F.reverse("text")))
    labels = table(spark, "labels")
    one, other = (quality_rank.scored(d, labels) for d in (docs.repartition(3), docs.orderBy(F.desc("doc_id"), "text").repartition(5, "text")))
    assert plain(one, "doc_id", "score") == plain(other, "doc_id", "score")


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)] + [(None, 1), (3, None)], "doc_id long, quality int")
    assert quality_rank.scored(odd, labels).count() == odd.count()
    assert {r.score for r in quality_rank.scored(odd, labels.filter("false")).collect()} == {0.5}
    assert quality_rank.scored(odd.filter("false"), labels).count() == 0


def test_toxicity_on_unseen_rows(spark):
    """In every language, also where nobody has named its words."""
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, "documents", folder), table(spark, "labels", folder)
    unseen = "crc32(cast(doc_id as string)) % 4 = 2"
    found = toxicity.scored(docs, labels.filter(f"not ({unseen})")).join(labels.filter(unseen).withColumnRenamed("toxic", "wanted"), "doc_id")
    found = found.join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.toxic == found.wanted).mean() > 0.97
    toxic = found[found.wanted == 1]
    by_lang = toxic.groupby("lang").toxic.mean()
    assert toxic.toxic.mean() > 0.85 and by_lang.min() > 0.5  # Spanish has 22 toxic rows to learn from
    # Earlier categories tell something in each language.
    kinds = ["p_kind1", "p_kind2", "p_kind3"]
    assert (toxic.groupby("lang")[kinds].mean().max(axis=1) > 2 * found[found.wanted == 0].groupby("lang")[kinds].mean().max(axis=1)).all()


def test_toxicity_equals_a_plain_chain(spark):
    docs, labels = table(spark), table(spark, "labels")
    rows = [tuple(r) for r in docs.select("doc_id", "lang", "text").collect()]
    flags = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id is not None}
    folds = {r.doc_id: r.fold for r in docs.select("doc_id", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(toxicity.FOLDS)).alias("fold")).collect()}
    wanted = brute.chain(rows, flags, folds, toxicity)
    got = {r.doc_id: tuple(r)[1:5] for r in toxicity.scored(docs, labels).collect()}
    assert len(wanted) == len(rows)
    for id, chances in wanted.items():
        assert got[id] == pytest.approx(chances, abs=1e-6)


def test_kinds_are_found_in_each_language_by_itself():
    # Features 0 and 1 go together, 2 alone, 3 is in another language; 4 says nothing.
    texts = [[0, 1, 4], [0, 1], [2, 4], [2]] * 10 + [[4], []] * 40 + [[3], [3, 4]] * 10 + [[], [4]] * 20
    flag = np.array([1] * 40 + [0] * 80 + [1] * 20 + [0] * 40)
    langs = np.array(["a"] * 120 + ["b"] * 60)
    counts, index = np.array([len(t) for t in texts]), np.array([i for t in texts for i in t])
    found = toxicity.kinds_of(counts, index, flag, langs)
    assert found[:4].tolist() == [[1, 0, 0], [1, 0, 0], [0, 1, 0], [0, 1, 0]]
    assert found[120:122].tolist() == [[1, 0, 0]] * 2 and not found[flag == 0].any()
    assert not toxicity.kinds_of(counts, index, np.zeros(180, int), langs).any()


def test_toxicity_by_given_categories(spark):
    docs = spark.createDataFrame([(k, f"{'rude' if k % 2 else 'kind'} {'loud' if k % 3 else 'calm'}", 1) for k in range(60)], "doc_id long, text string, __lang int")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("rude"), F.when(F.col("doc_id") % 2 == 1, F.least(F.lit(1), F.col("doc_id") % 3)).otherwise(0).alias("bad"))
    found = toxicity.scored(docs, labels, ("rude", "bad"))
    assert found.columns == ["doc_id", "p_rude", "p_bad", "toxic"]
    assert all((r.p_rude > 0.5) == (r.doc_id % 2 == 1) and r.toxic == (r.doc_id % 2 == 1 and r.doc_id % 3 > 0) for r in found.collect())


def test_preferences_equal_a_plain_fit():
    random = np.random.default_rng(1)
    x = random.normal(size=(40, quality_rank.N_FEATURES)).astype(np.float32)
    good = x[:, 0] + x[:, 1] > 0.3
    model = quality_rank.fit(x, good, pairs=200)
    basis, weights, scores = brute.preferences(x.tolist(), good.tolist(), 200, quality_rank)
    assert np.allclose(model.basis(x.astype(float)), basis, atol=1e-9) and np.allclose(model.weights, weights, atol=1e-6)
    assert np.allclose(model.score(x), scores, atol=1e-6)


def test_every_row_and_pair_is_fitted_on(spark, monkeypatch):
    """The slope over all pairs, one by one, is flat; quantiles and cut are those of all rows."""
    monkeypatch.setattr(quality_rank, "BLOCK", 16)
    random = np.random.default_rng(5)
    x = random.normal(size=(150, quality_rank.N_FEATURES)).astype(np.float32)
    x[:, 3], x[::3, 4] = 0, -x[0, 4]
    good = x[:, 0] + x[:, 1] + random.normal(size=150) > 0.3
    rows = spark.createDataFrame([(k, x[k].tolist()) for k in range(150)], "doc_id long, x array<float>")
    labels = spark.createDataFrame([(k, int(good[k])) for k in range(150)], "doc_id long, quality int")
    used = np.array([zlib.crc32(str(k).encode()) % 4 != 2 for k in range(150)])
    x, good = x[used].astype(float), good[used]
    blocks = quality_rank.training(rows, labels)
    assert blocks.count() > 3 and sum(len(r.good) for r in blocks.collect()) == len(x)
    model = quality_rank.fit_all(blocks)
    assert np.allclose(model.middle, x.mean(axis=0)) and np.allclose(model.scale, np.maximum(x.std(axis=0), 1e-6))
    assert np.array_equal(model.edges, np.quantile(x, np.linspace(0, 1, quality_rank.BINS + 1)[1:-1], axis=0).T)
    basis = model.basis(x)
    pairs = (basis[good][:, None] - basis[~good]).reshape(-1, basis.shape[1])
    slope = quality_rank.RIDGE * model.weights - (pairs / (1 + np.exp(pairs @ model.weights))[:, None]).mean(axis=0)
    assert np.abs(slope).max() < 1e-5
    assert model.cut == pytest.approx(np.quantile(basis @ model.weights, (~good).mean()), abs=1e-9)


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)] + [(None, 1), (3, None), (77, 1)], "doc_id long, toxic int")
    assert toxicity.scored(odd, labels).count() == odd.count()
    assert toxicity.scored(odd, labels.filter("false")).count() == odd.count()
    assert toxicity.scored(odd.filter("false"), labels).count() == 0
