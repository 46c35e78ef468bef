"""Texts read by the batch against the row-wise readers, and queries whose candidates stay where their text is read."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scriptorium import rules
from scriptorium.functions import text as T
from scriptorium.operators import candidates as C
from scriptorium.operators import evaluate as E
from scriptorium.operators import merge as M
from scriptorium.operators import recognise as Z
from scriptorium.operators import scan as A
from scriptorium.plans.queries import QUERIES

SIGNS = "中郎將軍大太守漢朝元州年唐初入。，《》建武國abcx\n\x01\U00020000é"


def texts_of(seed, n=6, size=30):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(SIGNS[: rnd.choice([8, 20, len(SIGNS)])]) for _ in range(rnd.randint(0, size))) for _ in range(n)]


@pytest.mark.parametrize("patterns", [rules.PATTERNS, (("A", "中郎將|將軍|大將軍|軍中"), ("B", "[大中]{1,3}軍"), ("C", "(?:大|大中)"), ("D", "郎(?=將)"), ("E", "x*"), ("F", "(?i)[AB].$"))])
def test_patterns_by_batch(patterns):
    compiled = C._compiled(patterns)
    reader = A.Patterns([p for _, p in compiled], list(range(len(compiled))))
    for seed in range(100):
        texts = [None, *texts_of(seed)]
        column = pa.array(["漢", *texts, "a"], pa.string()).slice(1, len(texts))
        t = A.Texts(column)
        (start, end, code), _ = reader.found(t)
        row = t.rows(start)
        got = [(int(k), patterns[c][0], int(a - t.first[k]), int(b - t.first[k])) for k, c, a, b in zip(row, code, start, end)]
        assert got == sorted(((k, *x) for k, v in enumerate(texts) for x in C.spans(v or "", compiled)), key=lambda x: (x[0], x[2]))
        assert t.cut(start, end).to_pylist() == [texts[k][a:b] for k, _, a, b in got]


@pytest.mark.parametrize("dense", [True, False])
def test_words(dense):
    words = ["a", "ab", "漢", "漢朝", "朝漢", "abc", "bca"]
    w = A.Words(words)
    w.ready()
    w.dense = w.dense if dense else None
    for seed in range(50):
        rnd = random.Random(seed)
        texts = ["".join(rnd.choice("abc漢朝x\U00020000") for _ in range(rnd.randint(0, 12))) for _ in range(5)]
        t = A.Texts(pa.array(texts))
        start, _, word = w.found(t)
        got = sorted((int(t.row[a]), int(a - t.first[t.row[a]]), words[k]) for a, k in zip(start, word))
        assert got == sorted((k, i, x) for k, v in enumerate(texts) for x in words for i in range(len(v)) if v.startswith(x, i))


@pytest.mark.parametrize("few", [1, 24, 10**6])
def test_fold_by_batch(few, monkeypatch):
    monkeypatch.setattr(A, "FEW", few)
    mapping, labels, sources = rules.LabelMapping(), sorted(rules.INTERNAL_LABELS), ["cbdb", "regex", "seed"]
    fits = np.array([[mapping.fits(a, b) for b in labels] for a in labels])
    prefers = np.array([[labels.index(mapping.preferred(a, b)) for b in labels] for a in labels])
    rnd = random.Random(few)
    for _ in range(60):
        rows, want, clashes, base = [], [], [], 0
        for _ in range(rnd.randint(1, 40)):
            own = []
            for _ in range(rnd.randint(0, 12)):
                a = rnd.randint(0, 10)
                own.append({"text": "x", "label": rnd.choice(labels), "start": a, "end": a + rnd.randint(1, 4), "source": rnd.choice(sources), "source_id": None,
                            "priority_score": 0.5, "matched_alias": None, "linking_candidates": [], "linking_status": None})
            entities, conflicts = M.fold(own, mapping, ("cbdb",))
            want += [(base + e["start"], base + e["end"], e["label"]) for e in entities]
            clashes += [(c["kind"], *[(base + x["start"], base + x["end"], x["label"]) for x in c["candidates"]]) for c in conflicts]
            rows += [(base + c["start"], base + c["end"], labels.index(c["label"]), sources.index(c["source"])) for c in own]
            base += 20
        start, end, label, source = np.array(rows, np.int64).reshape(-1, 4).T
        order = A.in_order(start, end, label, source)
        start, end, label, source = start[order], end[order], label[order], source[order]
        owner, final, lives, (c, e, kind) = A.fold(start, end, label, fits, prefers, source == 0)
        at = np.flatnonzero((owner == np.arange(len(start))) & lives)
        span = lambda i, x: (int(start[i]), int(end[i]), labels[x])
        assert [span(i, final[i]) for i in at] == want
        assert [(A.KINDS[k], span(i, label[i]), span(j, final[j])) for i, j, k in zip(c, e, kind)] == clashes


@pytest.mark.parametrize("most_terms", [C.BROADCAST_TERMS, 3])
def test_one_pass_equals_merge(spark, most_terms):
    texts = [f"漢朝太守{t}入漢初元年至{t}州" for seed in range(8) for t in texts_of(seed, 4)]
    rows = [(f"r{k // 5}-{k}", f"r{k // 5}", k, 7 * k, 7 * k + len(t), t) for k, t in enumerate(texts)]
    sents = spark.createDataFrame([*rows, ("r9-x", "r9", 0, 0, 0, "xy"), ("r9-y", "r9", 1, 0, 0, None)], "sid string, id string, idx long, start int, end int, text string")
    terms = C.seed_terms(spark, [("守", "PERSON"), ("守", "PERSON"), ("漢朝", "LOCATION")])
    old = M.annotate(sents, C.pattern_candidates(sents).unionByName(C.seed_candidates(sents, terms)))
    full = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    bare = lambda c, *names: F.transform(c, lambda e: e.dropFields(*names))
    want = old.select("sid", full(bare("entities", "eid", "sentence_id")), full(bare("conflicts", "offset_scope", "sentence_id"))).collect()
    got = Z.sentences(sents, terms, most_terms=most_terms)
    assert sorted(got.select("sid", full("entities"), full("conflicts")).collect()) == sorted(want) and any(r[2] != "[]" for r in want)
    slim = Z.sentences(sents, terms, fields=("label",), whole_conflicts=False, most_terms=most_terms)
    assert sorted(slim.select("sid", F.to_json("entities.label")).collect()) == sorted(old.select("sid", F.to_json("entities.label")).collect())
    one = F.struct("idx", F.struct("sid", "start", "text").alias("s"))
    recs = sents.groupBy("id").agg(F.array_sort(F.collect_list(one)).alias("x")).select("id", F.col("x.s").alias("sentences"))
    nested = M.to_records(old.withColumn("record_text", F.lit(""))).select("id", full("entities"), full("unresolved_conflicts")).collect()
    assert sorted(Z.records(recs, terms, most_terms=most_terms).select("id", full("entities"), full("unresolved_conflicts")).collect()) == sorted(nested)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["corpus_round_trip", "sample_cards", "diagnostic_strata", "sentence_features", "merge_entities", "entity_stats", "merge_conflicts", "export_rows", "export_manifest"])
def test_candidates_stay_where_they_are_found(spark, name, monkeypatch):
    """No query collects candidates by sentence, and a corpus is written without a shuffle of what it holds."""
    from scriptorium.sources import corpus

    plans, write = [], corpus.write_rows
    monkeypatch.setattr(corpus, "write_rows", lambda rows, path, force=True: (plans.append(plan_of(rows)), write(rows, path, force))[1])
    plans.append(plan_of(QUERIES[name](spark, "/root/testdata/sf0.001")))
    assert all("collect_list" not in p for p in plans)


SPANS = "sentence_id string, start int, end int, label string"


def test_spans_of_sentences_count_like_spans(spark):
    """Sentences that hold both sides give what spans give, with repeated ids, null ids, nulls in spans and several labels of a place."""
    rnd = random.Random(5)
    draw = lambda n: [(rnd.choice(["a", "b", "c", None, "global"]), rnd.choice([*range(5), None] if k % 9 == 0 else range(5)), rnd.choice([6, 7, 1 << 30]),
                       rnd.choice(["X", "Y", "Z", None] if k % 7 == 0 else ["X", "Y"])) for k in range(n)]
    gold, pred = spark.createDataFrame(draw(90), SPANS), spark.createDataFrame(draw(70), SPANS)
    tag = lambda df, side: df.select("sentence_id", (F.rand(3) * 3).cast("int").alias("k"), F.struct("start", "end", "label").alias("x"), F.lit(side).alias("side"))
    own = lambda side: F.collect_list(F.when(F.col("side") == side, F.col("x"))).alias(side)
    both = tag(gold, "gold").unionByName(tag(pred, "pred")).groupBy("sentence_id", "k").agg(own("gold"), own("pred"))
    for f in (E.strict, E.boundary, E.per_label, E.confusion):
        assert sorted(map(repr, f(both).collect())) == sorted(map(repr, f(gold, pred).select(*f(both).columns).collect()))
    def key(r):
        return (r[0] or "global", *r[1:])
    g, p = {key(r) for r in gold.collect()}, {key(r) for r in pred.collect()}
    tp = len({r for r in g & p if None not in r})
    assert E.strict(gold, pred).select("tp", "fp", "fn").first() == (tp, len(p) - tp, len(g) - tp)


@pytest.mark.parametrize("name", ["eval_strict", "eval_boundary", "eval_per_label", "eval_confusion"])
def test_matches_are_found_once(spark, name):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "Join" not in plan and plan.count("translate(") == 1


def test_line_rules_read_a_line_once(spark):
    """Edges are trimmed without a pattern, patterns run where what they need is there, and the results are those of the patterns."""
    assert "regexp_replace" not in str(T.audit(F.col("l")))
    han, edges = "[\\x{3400}-\\x{9fff}]", "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$"
    old = F.regexp_replace("l", edges, "")
    edge = lambda body: f"(?:(?<={han})|^){body}(?:(?={han})|$)"
    tests = [("ocr_placeholder", old.rlike("\\[[0-9A-F]{2,8}\\]") | old.rlike(edge("[A-F][0-9A-F]{2,7}")) | old.rlike(edge("[A-Z]{2,8}"))),
             ("url", old.rlike("https?://\\S+") | old.rlike("(?i)\\bReferenced:\\s*")), ("wiki_footer", old.rlike("(?i)\\{\\{footer\\b")),
             ("ellipsis", old.rlike("…{5,}") & ~old.rlike(han))]
    rnd = random.Random(2)
    bits = [*" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u180e\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff", *"漢甲ABFZ09a[]{}:…", "AB", "F8D5", "https://", "http://a", "reFerenced:", "{{Footer", "x", "…" * 5]
    rows = [("".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9))),) for _ in range(6000)] + [(None,)]
    df = spark.createDataFrame(rows, "l string")
    got = df.select("l", T.strip(F.col("l")).alias("s"), old.alias("s0"), T.normalize(F.col("l")).alias("n"), F.regexp_replace(old, "[ \\t\\x{a0}]+", " ").alias("n0"),
                    T.review_reasons(F.col("l")).alias("r"), F.filter(F.array(*[F.when(t, F.lit(x)) for x, t in tests]), lambda x: x.isNotNull()).alias("r0")).collect()
    assert [r for r in got if (r["s"], r["n"], r["r"]) != (r["s0"], r["n0"], r["r0"])] == []
    assert {x for r in got for x in r["r"] or []} == {x for x, _ in tests}


@pytest.mark.parametrize("name", ["removed_stats", "work_statistics", "title_drop"])
def test_lines_are_read_before_they_are_dealt_by_file(spark, name):
    """Windows by file get what was found in a line, and not the line."""
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    above = plan[: plan.index("Exchange hashpartitioning(file")]
    assert "Window" in above and "RLIKE" not in above and "trim(" not in above
