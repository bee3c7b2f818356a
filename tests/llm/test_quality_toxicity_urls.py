"""Operators 3, 4 and 7 against brute force, planted cases and edge cases."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F
import xxhash

import corpus_pipeline
from reshift.llm import quality, queries, toxicity, urls
from tests.conftest import SF_MEDIUM, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FILLER = [f"{a}{b}" for a in "abcdefghij" for b in "lmnopqrs"]


def prose(rng, n):
    return " ".join(rng.choice(FILLER, n))


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text), repeated, len(covered), failed)


def spark_hash(value, seed=42):
    return xxhash.xxh64_intdigest(value.encode(), seed=seed)


def buckets(text):
    tokens = re.findall(r"[^\W_]+|(?:[^\w\x20\x09-\x0D]|_)+", text)
    single = [spark_hash(t) for t in tokens]
    # several columns are hashed one after the other, each seeded by the hash before
    double = [spark_hash(b, h) for h, b in zip(single, tokens[1:])]
    return [h & (quality.BUCKETS - 1) for h in single + double]


def brute_quality(documents, labels):
    grams = [buckets(t or "") for _, t in documents]
    trusted_ids = {d for d, q in labels if q == 1}
    raw, trusted = Counter(), Counter()
    for (doc, _), g in zip(documents, grams):
        raw.update(g)
        if doc in trusted_ids:
            trusted.update(g)
    total_raw, total_trusted = (sum(c.values()) + quality.BUCKETS for c in (raw, trusted))
    w = {b: math.log((trusted[b] + 1) / total_trusted) - math.log((raw[b] + 1) / total_raw) for b in raw}
    return [sum(w[b] for b in g) / len(g) if g else 0.0 for g in grams]


ODD = ["", None, " \n\t ", "one", "a b c d e f g h", "x y " * 40, "same line\nsame line\n\n \nsame line ",
       "# * $ <tag> | & %", "\x0b\x0cw\r\nv", "é ü ñ " * 10, " ".join(f"w{i}" for i in range(30)) * 2,
       ("p q r s t u v w " + "z" * 5 + " ") * 3, "a" * 100_000 + " b" * 3000, "a\u2028b \xa0c"]


@pytest.mark.parametrize("extra", [False, True])
def test_base_counts(spark, extra):
    rows = [(i, t, 0.5, "c") for i, t in enumerate(ODD)] + [(None, "null id", 0.1, "c"), (1, ODD[4], 0.2, "c")]
    names = "doc_id long, text string, quality double, counts string" if extra else \
        "doc_id long, text string, a double, b string"
    docs = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.judge(docs, labels, into="verdict").collect()
    assert len(got) == len(rows)
    for r in got:
        v = r["verdict"]
        assert (v["n_words"], v["word_chars"], v["n_symbols"], v["n_dup_lines"], v["n_repeat_words"],
                v["base_failed"]) == base(r["text"])
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns


def test_scores_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    good = [(i, prose(rng, 60)) for i in range(60)]
    junk = [(100 + i, " ".join(w.upper() + "!!" for w in prose(rng, 60).split())) for i in range(12)]
    documents = good + junk
    labels = [(d, 1) for d, _ in good[:30]] + [(d, 0) for d, _ in junk[:6]]
    scores = brute_quality(documents, labels)
    got = {r["doc_id"]: r["quality"] for r in quality.judge(
        spark.createDataFrame(documents, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    for (doc, _), score in zip(documents, scores):
        assert got[doc]["score"] == pytest.approx(score, abs=1e-6)
        assert got[doc]["kept"] == (doc < 100)


def test_quality_learns_from_every_label(spark):
    """More labels than the 20,000 that were once counted; ids that are null, repeated or without a label."""
    n = 24_000
    rows = [(i, f"w{i % 97} w{i % 89} common" if i % 5 else f"W{i % 83}!! x{i % 7}") for i in range(n)]
    rows += [(None, "w1 no id")] * 40 + [(3, "again w2"), (5, None), (n + 1, "w3 unlabelled"), (n + 2, "!!")]
    labels = [(i, int(i % 5 > 0)) for i in range(n)] + [(None, 1), (n + 1, None), (n + 2, 2), (n + 9, 1), (3, 0)]
    quality_of = {d: q for d, q in labels if d is not None} | {3: 0}  # of several labels the smallest counts
    scores = brute_quality(rows, list(quality_of.items()))
    means = [np.mean([score for (d, _), score in zip(rows, scores) if d is not None and quality_of.get(d) == q])
             for q in (0, 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.judge(documents, table).select("text", "quality.score").distinct().collect()
    wanted = {t: score for (_, t), score in zip(rows, scores)}
    assert {r["text"] for r in got} == wanted.keys()
    assert all(r["score"] == pytest.approx(wanted[r["text"]], abs=1e-6) for r in got)
    _, threshold = quality.fit(documents.fillna("", "text"), table)
    assert threshold == pytest.approx(sum(means) / 2, abs=1e-7)


def test_shares_are_computed_once_a_document(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    plan = quality.count_grams(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    # the plan's root is at its top: what is below ``Generate`` runs before the n-grams become rows
    assert "round(" in plan and "round(" not in plan[:plan.index("Generate explode")]


def test_repeated_words_of_random_texts(spark):
    """Few words, so that windows of eight repeat, overlap and reach both ends of the text."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(list("ab"), n)) for n in [*range(7, 40)] * 2]
    texts += [" ".join(rng.choice(FILLER[:5], 12).tolist() * 2 + rng.choice(FILLER, n).tolist()) for n in range(12)]
    texts += [" ".join(f"w{i % n}" for i in range(16)) for n in (7, 8, 9)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in docs.select("text", quality.repeated_words(quality.words_of(F.col("text"))).alias("n")).collect():
        assert r["n"] == base(r["text"])[4], r["text"]


def test_pipeline_judges_by_every_label(spark, tmp_path):
    """The few labels of the documents count beside many others: a sample would miss most of them."""
    rng = np.random.default_rng(6)

    def about(topic):
        return " ".join(rng.choice([f"{topic}{x}" for x in "bcdfghjklmnp"], 60))

    # each topic has one labelled document and one without a label
    good, junk = ([(at + i, about(f"{name}{i % 30}")) for i in range(60)] for at, name in ((0, "good"), (100, "junk")))
    labels = [(i, int(i < 60)) for i in [*range(30), *range(100, 130)]]
    others = spark.range(1000, 401_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    spark.createDataFrame(labels, "doc_id long, quality int").union(others).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(good + junk, "doc_id long, text string")
    kept = [r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept) == [d for d, _ in good]


def test_quality_on_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.judge(none, labels).collect() == []


def test_quality_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    plan = quality.judge(docs, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions", plan)


def test_insults_are_learnt_and_pairs_count():
    """Toxic if an insult meets a group, harmless if either stands alone: their pair gets weight."""
    rng = np.random.default_rng(1)
    rows, toxic = [], []
    for i in range(1200):
        noise = rng.choice(np.arange(100, 400), 15, replace=False).tolist()
        a, b = rng.random() < 0.4, rng.random() < 0.4
        rows.append(sorted(noise + [1] * a + [2] * b))
        toxic.append(int(a and b))
    machine = toxicity.fit(rows, np.array(toxic))
    flat, starts = toxicity._flat(rows)
    score = toxicity._sigmoid(machine.margins(flat, starts))
    assert ((score >= 0.5) == np.array(toxic)).mean() > 0.97
    place = machine.place[[1, 2]]
    assert machine.v[place[0]] @ machine.v[place[1]] > 0


def told_only_together(n, seed):
    """Terms 1 and 2 (in 2 % and 5 % of the rows) say nothing alone: with them apart, fewer rows are toxic."""
    rng = np.random.default_rng(seed)
    a, b = rng.random(n) < 0.02, rng.random(n) < 0.05
    toxic = rng.random(n) < 0.11
    toxic[a & b] = True
    for one, both in ((a & ~b, a & b), (b & ~a, a & b)):  # as many toxic rows as among all
        few = max(round(0.11 * (one.sum() + both.sum()) - both.sum()), 0)
        toxic[one] = np.arange(one.sum()) < few
    rows = [sorted(rng.choice(np.arange(100, 3100), 40, replace=False).tolist() + [1] * x + [2] * z)
            for x, z in zip(a.tolist(), b.tolist())]
    return rows, toxic.astype(int), a & b, a ^ b


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_pair_without_marginal_effect_is_learnt(seed):
    rows, toxic, both, one = told_only_together(toxicity.MAX_LABELLED, seed)
    y = toxic - toxic.mean()
    for term in (1, 2):
        said = abs(sum(e for r, e in zip(rows, y) if term in r)) / len(y)
        assert said < toxicity.SCREEN * toxicity.SHRINK_TERMS / np.sqrt(len(y))
    machine = toxicity.fit(rows, toxic)
    score = toxicity._sigmoid(machine.margins(*toxicity._flat(rows)))
    assert (score[both] >= toxicity.THRESHOLD).all() and (score[~both] < toxicity.THRESHOLD).all()


def test_no_pairs_in_noise():
    rng = np.random.default_rng(9)
    rows, toxic, _, _ = told_only_together(4000, 9)
    toxic = rng.permutation(toxic)
    flat, starts = toxicity._flat(rows)
    assert len(toxicity.pairs_beyond(flat, starts, toxic * 1.0, np.full(4000, toxic.mean()))) <= 3


def test_sample_is_not_cut():
    assert toxicity.MAX_LABELLED >= 8000


def test_toxicity_edge_cases(spark):
    schema = "doc_id long, text string, toxic_score string"
    docs = spark.createDataFrame([(1, None, "x"), (None, "", "x"), (2, "idiot " * 30000, "x"), (2, "b", "x")], schema)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.judge(docs, labels).collect()
    assert len(got) == 4 and all(r["toxicity"]["score"] == 0 and r["toxicity"]["predicted"] == 0 for r in got)
    assert toxicity.keep_harmless(docs, labels).columns == docs.columns
    assert toxicity.judge(docs.limit(0), labels).collect() == []
    held = {r["doc_id"]: r["toxicity"]["held_out"] for r in got}
    import zlib
    assert held[2] == (zlib.crc32(b"2") % 4 == 2) and held[None] is False


def test_held_out_accuracy(spark):
    """Learnt on the other rows, the held-out labels of the small table are told well."""
    got = {r["doc_id"]: r for r in queries.op7_factorization_machine(spark, "/root/testdata/sf0.01").collect()}
    labels = ds.dataset("/root/testdata/sf0.01/labels.parquet").to_table().to_pylist()
    held = [(got[r["doc_id"]]["predicted"], r["toxic"]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert np.mean([p == t for p, t in held]) > 0.9
    assert sum(p == 1 and t == 0 for p, t in held) <= 2


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "https://a.example.com/en/", "x://com/",
        "http://com", "http://notcom/", "http://a.b.net/es/1", "http://net/fr/", "http://x.net/en/", "a://b://c/d",
        "http://É.com/é", "http://sub.www.example.com/en/y", "http://example.com?x=/en/", "http://h.org/" + "z" * 50_000]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
        host, slash, tail = rest.partition("/")
        path = slash + tail
        host = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in host)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text)) if fits else None


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, url_rule string")
    got = {r["page_id"]: r["url_verdict"] for r in urls.judge(pages).collect()}
    for i, u in enumerate(URLS):
        host, path, rule = brute_url(u)
        v = got[i]
        assert (v["host"], v["path"], v["rule"]) == (host, path, rule.text if rule else None), u
        assert v["verdict"] == (rule.verdict if rule else v["verdict"]) and v["verdict"] in ("allow", "block")
    assert urls.judge(pages.limit(0)).collect() == []


def test_trained_counts_are_exact_for_many_contexts(spark):
    """More distinct contexts of one order than any table of 32,768 slots tells apart."""
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz/é"))
    texts = sorted({"".join(rng.choice(letters, 24)) for _ in range(6000)})
    accepted = [bool(x) for x in rng.random(len(texts)) < 0.5]
    frame = spark.createDataFrame(list(zip(texts, accepted)), "text string, accepted boolean")
    fold = F.pmod(F.xxhash64("text"), F.lit(urls.CALIBRATION_FOLDS))
    seen = {r["text"] for r in frame.where(fold != 0).collect()}
    models, _ = urls.train(frame)

    def symbols_and_contexts(text):
        symbols = [b + 1 for b in text.encode()] + [0]
        padded = [-1] * urls.ORDER + symbols
        for i, s in enumerate(symbols):
            yield s, [(k, tuple(padded[urls.ORDER + i - k:urls.ORDER + i])) for k in range(urls.ORDER + 1)]

    counts = [Counter(), Counter()]
    for text, kind in zip(texts, accepted):
        if text in seen:
            for s, contexts in symbols_and_contexts(text):
                counts[kind].update(contexts)
                counts[kind].update((c, s) for c in contexts)
    assert len({c for table in counts for c in table if c[0] == urls.ORDER}) > 1 << 16
    probe = [*texts[:40], "", "é", "unlike/any", *(t[:10] + "x" for t in texts[40:60])]
    import pyarrow as pa
    counted, _ = urls.train(frame, most_keys=0)  # too many keys to send: the table of counts itself
    asked = spark.createDataFrame([(i, t) for i, t in enumerate([*probe, probe[0]])], "h1 int, text string")
    joined = {r["h1"]: r["score"] for r in urls.with_score(asked, F.col("text"), counted, "score").collect()}
    assert len(joined) == len(probe) + 1 and joined[len(probe)] == joined[0]
    sent = models.scores(pa.array(probe))
    assert [joined[i] for i in range(len(probe))] == pytest.approx(sent.tolist(), abs=1e-9)
    for text, score in zip(probe, sent):
        total = 0.0
        steps = list(symbols_and_contexts(text))
        for s, contexts in steps:
            p = [1 / 257, 1 / 257]
            for c in contexts:
                for m in (0, 1):
                    p[m] = (counts[m][c, s] + urls.SMOOTHING * p[m]) / (counts[m][c] + urls.SMOOTHING)
            total += math.log(p[1] / p[0])
        assert score == pytest.approx(total / len(steps), abs=1e-9)


@pytest.mark.parametrize("most_keys", [urls.MOST_KEYS, 10])
def test_threshold_and_verdict_without_a_rule(spark, most_keys):
    """The threshold has the best balanced accuracy on the URLs that the models did not see."""
    pages = spark.read.parquet(f"{SF_MEDIUM}/pages.parquet").select("page_id", "url")
    rows = urls.judge(pages, most_keys=most_keys).select(
        "url_verdict.*", F.pmod(F.xxhash64(F.concat("url_verdict.host", "url_verdict.path")),
                                F.lit(urls.CALIBRATION_FOLDS)).alias("fold")).collect()
    unseen = [(math.floor(r["score"] / urls.WIDTH), r["verdict"] == "allow") for r in rows if r["rule"] and r["fold"] == 0]
    good, bad = (sum(a == kind for _, a in unseen) for kind in (True, False))
    assert good and bad
    balance = {edge: sum(b >= edge for b, a in unseen if a) / good + sum(b < edge for b, a in unseen if not a) / bad
               for edge in range(-1000, 1002)}
    best = max(balance.values())
    threshold = min((e for e in balance if balance[e] >= best - 1e-12), key=abs) * urls.WIDTH
    judged = [r for r in rows if not r["rule"]]
    assert len(judged) > 50 and {r["verdict"] for r in judged} == {"allow", "block"}
    assert all((r["score"] >= threshold) == (r["verdict"] == "allow") for r in judged)


def test_registered_urls(spark):
    got = queries.op4_url_ratio(spark, SF_SMALL).collect()
    pages = ds.dataset(f"{SF_SMALL}/pages.parquet").to_table(columns=["page_id", "url"]).to_pylist()
    wanted = {p["page_id"]: brute_url(p["url"]) for p in pages}
    assert len(got) == len(pages)
    for r in got:
        host, path, rule = wanted[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        assert rule is None or r["verdict"] == rule.verdict
