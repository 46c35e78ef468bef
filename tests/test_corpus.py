"""Corpus operators on the literals their rules were written for."""

import gzip

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium import rules
from scriptorium.functions import text as T
from scriptorium.operators import candidates as C
from scriptorium.operators import evaluate as E
from scriptorium.operators import export as X
from scriptorium.operators import ingest as I
from scriptorium.operators import knowledge as K
from scriptorium.operators import merge as M
from scriptorium.operators import sample as S
from scriptorium.operators import segment as G
from scriptorium.operators import validate as V


def one(spark, rows, schema, **cols):
    return spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in cols.items()]).collect()


def test_volumes(spark):
    cases = {"卷099下": (99, "c"), "卷上": (0, "a"), "卷015": (15, ""), "卷15": (15, ""), "卷十六": (16, ""), "卷二十一": (21, ""), "卷015b": (15, "b"),
             "卷一百二十": (120, ""), "卷一二": (2, ""), "高帝紀": None, "卷": None, "": None}
    got = one(spark, [(k,) for k in cases], "h string", h=F.col("h"), v=T.volume(F.col("h")))
    assert {r["h"]: (r["v"]["number"], r["v"]["part"]) if r["v"] else None for r in got} == cases


def test_audit_and_normalize(spark):
    cases = {" ": ("drop", ["blank"]), "姊妹计划：": ("drop", ["boilerplate"]), "愚F8D5小生": ("needs_review", ["ocr_placeholder"]), "AT逆": ("needs_review", ["ocr_placeholder"]),
             "[CF3D]甲 https://a": ("needs_review", ["ocr_placeholder", "url"]), "{{footer|x}}": ("needs_review", ["wiki_footer"]), "……………": ("needs_review", ["ellipsis"]),
             "甲……………": ("keep", []), "高祖": ("keep", [])}
    got = one(spark, [(k,) for k in cases], "l string", l=F.col("l"), a=T.audit(F.col("l")))
    assert {r["l"]: (r["a"]["decision"], r["a"]["reasons"]) for r in got} == cases
    assert one(spark, [("　甲 \t 乙　",)], "l string", n=T.normalize(F.col("l")))[0]["n"] == "甲 乙"
    assert one(spark, [("漢書",)], "l string", a=T.audit(F.col("l"), F.lit("漢書")))[0]["a"]["reasons"] == ["work_title"]


def test_export_volume(spark):
    cases = {"": "00", "015b": "015b", "7": "7", "第7回": "07", "上": "a"}
    got = one(spark, [(k,) for k in cases], "v string", v=F.col("v"), o=T.export_volume(F.col("v")))
    assert {r["v"]: r["o"] for r in got} == cases


def test_ingest(spark, tmp_path):
    (tmp_path / "漢書_full.txt").write_text("漢書\n# 卷一\n# 卷一\n## 高帝紀\n漢書\n高祖，沛人也。\n\n# 卷二\n漢書\n惠帝。\n# 卷一\n完\n", "utf-8")
    lines = I.read_lines(spark, str(tmp_path))
    st_ = I.structure(I.with_works(lines, I.works(spark)))
    got = [(r["line_no"], r["text"], r["volume_id"], r["section"]) for r in I.records(st_).orderBy("line_no").collect()]
    assert got == [(6, "高祖，沛人也。", "001", "高帝紀"), (9, "漢書", "002", None), (10, "惠帝。", "002", None), (12, "完", "001", None)]
    assert {(r["reason"], r["lines"]) for r in I.removed_counts(st_).collect()} == {("heading", 5), ("work_title", 2), ("blank", 1)}
    assert [(r["number"], r["events"]) for r in I.repeated_headings(st_).collect()] == [(1, 2)]
    assert I.audit_rows(st_).count() == 3


@pytest.mark.parametrize("text,want", [
    ("甲。乙！ 丙", [(0, 2), (2, 4), (5, 6)]), ("甲「乙。丙」丁。戊", [(0, 8), (8, 9)]), ("「甲（乙」。丙", [(0, 6), (6, 7)]), ("（甲。乙。", [(0, 5)]), ("》甲。", [(0, 3)]), ("  。 ", [(2, 3)]), ("", [])])
def test_segment(text, want):
    assert G.spans(text) == want


def cand(text, label, start, end, source="regex", source_id=None):
    return {"text": text, "label": label, "start": start, "end": end, "source": source, "source_id": source_id, "priority_score": 0.5, "matched_alias": None,
            "linking_candidates": [], "linking_status": None}


@pytest.mark.parametrize("rows,want,kinds", [
    ([cand("高祖", "PERSON", 0, 2), cand("高祖", "PERSON", 0, 2, "seed")], [("PERSON", 0, 2)], []),
    ([cand("漢", "DYNASTY", 0, 1, "seed"), cand("漢", "POLITY", 0, 1)], [("DYNASTY", 0, 1)], []),
    ([cand("王", "PERSON", 0, 1), cand("王", "LOCATION", 0, 1, "seed")], [], ["same_span_label"]),
    ([cand("a", "PERSON", 0, 3), cand("b", "LOCATION", 1, 4)], [], ["partial_overlap"]),
    ([cand("長安", "LOCATION", 0, 2), cand("長", "LOCATION", 0, 1, "kb")], [], ["nested_critical"]),
    ([cand("長安", "LOCATION", 0, 2), cand("長", "LOCATION", 0, 1, "seed")], [("LOCATION", 0, 2)], []),
    ([cand("x", "LOCATION", 0, 2), cand("x", "PERSON", 0, 2), cand("x", "TIME", 0, 2)], [("TIME", 0, 2)], ["same_span_label"]),
    ([cand("x", "LOCATION", 0, 5), cand("y", "PERSON", 1, 2), cand("z", "TIME", 3, 6)], [("TIME", 3, 6)], ["nested_label"])])
def test_fold(rows, want, kinds):
    entities, conflicts = M.fold(rows, rules.LabelMapping(), ("kb",))
    assert [(e["label"], e["start"], e["end"]) for e in entities] == want
    assert [c["kind"] for c in conflicts] == kinds


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(1, 4), st.sampled_from("ABC"))))
def test_fold_keeps_spans_apart(rows):
    got, _ = M.fold([cand("x", x, a, a + n) for a, n, x in rows], rules.LabelMapping())
    assert all(a["end"] <= b["start"] for a, b in zip(got, got[1:]))


def test_annotate_end_to_end(spark):
    recs = spark.createDataFrame([("r1", "高祖入漢，為太守。建武元年至長安城。《史記》曰。", "西漢")], "id string, text string, period string")
    sents = G.sentences(recs)
    people = spark.createDataFrame([("高祖", [(1, 29)])], "name string, people array<struct<person_id:int,dynasty:int>>")
    found = C.pattern_candidates(sents).unionByName(C.seed_candidates(sents, C.seed_terms(spark))).unionByName(C.person_candidates(sents, people, "all"))
    ann = M.annotate(sents, found)
    ents = [(e["text"], e["label"], e["start"], e["eid"]) for r in ann.orderBy("idx").collect() for e in r["entities"]]
    text = recs.first()["text"]
    assert [(t, x) for t, x, _, _ in ents][:3] == [("高祖", "PERSON"), ("漢", "DYNASTY"), ("太守", "OFFICIAL_TITLE")]
    assert all(text[a : a + len(t)] == t for t, _, a, _ in ents) and [e[3] for e in ents] == [f"r1-e{k + 1}" for k in range(len(ents))]
    nested = M.to_records(ann).first()
    assert len(nested["entities"]) == len(ents) and len(nested["sentences"]) == 3


def test_knowledge(spark):
    persons = spark.createDataFrame([(1, "王安石", 15), (2, "劉備", 3), (3, "劉備", 3), (4, "未詳", 0), (5, "安", 15), (6, "唐貞觀", 6)], "person_id int, name string, dynasty int")
    aliases = spark.createDataFrame([(1, "介甫", 4), (1, "(王+安)", 4), (2, "玄德", 4), (2, "國師", 8)], "person_id int, alias string, type int")
    eras = spark.createDataFrame([("唐", "貞觀")], "dynasty string, era string")
    names, counts = K.build_names(persons, aliases, eras)
    want = {"person_total": 6, "person_kept": 3, "primary_names": 3, "alias_total": 4, "alias_allowed_type": 3, "alias_names": 2, "unique_names": 4, "blocked_nonperson": 1}
    assert counts.first().asDict() == want
    more = aliases.union(spark.createDataFrame([(6, "太宗", 4)], aliases.schema))
    names, counts = K.build_names(persons, more, eras)
    assert names.where("name = '太宗'").count() == 0 and counts.first()["alias_names"] == 2
    assert K.build_names(persons, None, eras)[1].first()["alias_total"] == 0 and K.build_names(persons, aliases.drop("type"), eras)[1].first()["alias_allowed_type"] == 4
    decomposed = spark.createDataFrame([(1, "\uf900\uf901", 1)], "person_id int, name string, dynasty int")
    assert K.clean_persons(decomposed).first()["primary_name"] == "\u8c48\u66f4"  # normal form C
    surf = {r["name"]: [p["person_id"] for p in r["people"]] for r in K.surfaces(names, persons).collect()}
    assert surf["劉備"] == [2, 3] and surf["王安石"] == [1] and "唐貞觀" not in surf


def test_places_and_seeds(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,name,begin,end,type,parent\n1,長安,1,9,x,\n2,沛,a,9,x,\n", "utf-8")
    assert [r["place_id"] for r in K.read_places(spark, str(tmp_path / "p.csv")).collect()] == ["1"]
    path = str(tmp_path / "seeds.jsonl.gz")
    body = K.write_seeds(path, rules.seeds(), "1", "CC0")
    assert body["row_counts"] == {"DYNASTY": 12, "LOCATION": 10, "OFFICIAL_TITLE": 20, "POLITY": 7} and K.read_seeds(spark, path).count() == 49
    before = gzip.open(path).read()
    K.write_seeds(path, rules.seeds()[::-1], "1", "CC0")
    assert gzip.open(path).read() == before
    open(path, "ab").write(b"x")
    with pytest.raises(ValueError):
        K.check_manifest(path)


def test_metrics_on_empty_and_wrong(spark):
    schema = "sentence_id string, start int, end int, label string"
    none = spark.createDataFrame([], schema)
    gold = spark.createDataFrame([("s", 0, 2, "A"), ("s", 0, 2, "A"), ("t", 1, 2, "B")], schema)
    pred = spark.createDataFrame([("s", 0, 2, "B"), ("u", 1, 2, "B")], schema)
    assert E.strict(gold, none).first()["f1"] == 0.0 and E.strict(gold, gold).first()["f1"] == 1.0
    assert E.strict(gold, pred).first()["tp"] == 0 and E.boundary(gold, pred).first()["tp"] == 1 and E.label_accuracy(gold, pred).first()["accuracy"] == 0.0
    assert E.regressed(0.5, 0.4) and not E.regressed(0.4, 0.4)


def test_samples(spark):
    rows = spark.createDataFrame([(f"{t}-{i}", t, "甲" * (i + 1), i % 2 == 0, i > 80, False, ["PERSON", "TIME"][: i % 3]) for t in "abcd" for i in range(40)],
                                 "sid string, title string, text string, has_punct_end boolean, is_long boolean, has_note boolean, labels array<string>")
    p, c = S.pilot(rows, 20)
    got, other = {r["sid"] for r in p.collect()}, {r["sid"] for r in c.collect()}
    assert len(got) == 20 and not got & other and {x[0] for x in got} == set("abcd")
    assert got == {r["sid"] for r in S.pilot(rows, 20)[0].collect()}
    with pytest.raises(ValueError):
        S.pilot(rows.limit(0), 5)


def test_mapping_rules(tmp_path):
    with pytest.raises(rules.MappingError):
        rules.LabelMapping(to_submission={"PERSON": "PER"})
    with pytest.raises(rules.MappingError):
        rules.LabelMapping(conflict_policy="maybe")
    m = rules.LabelMapping()
    assert m.fits("POLITY", "DYNASTY") and not m.fits("PERSON", "TIME") and m.preferred("POLITY", "DYNASTY") == "DYNASTY" and m.preferred("TIME", "BOOK") == "BOOK"


def test_tree_round_trip(spark, tmp_path):
    recs = spark.createDataFrame([("r1", "漢朝太守。至長安。", "HCH_006", "001")], "id string, text string, work_id string, volume string")
    sents = G.sentences(recs)
    ann = M.annotate(sents, C.pattern_candidates(sents))
    rows = X.export_rows(ann, ["idx"])
    body = X.write_tree(rows, str(tmp_path / "out"), "sha")
    assert body["n_sentences"] == 2 and body["n_volumes"] == 1
    seg, ner = X.read_tree(spark, str(tmp_path / "out"))
    assert [r["text"] for r in seg.orderBy("pos").collect()] == ["漢朝太守。", "至長安。"]
    assert V.compliance_issues(seg, ner, 2, "final").count() == 0
    assert {r["code"] for r in V.compliance_issues(seg, ner, 3).collect()} == {"sentence_count_mismatch"}
    with pytest.raises(ValueError):
        X.export_rows(ann, ["idx"], "final")
    assert "<mark" in X.marked("漢朝<b>", [{"start": 0, "end": 2, "label": "ORG"}]) and "&lt;b&gt;" in X.marked("漢朝<b>", [])


def test_json_rule(spark):
    lines = spark.createDataFrame([('{"a":1}',), ("",), ("{",), ("3",)], "value string")
    assert V.json_issues(lines).count() == 3


def test_entry_imports():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_dictionary_blocks(spark):
    """Matches across block edges, context at them, null and empty texts."""
    text = "甲" * (C.BLOCK - 2) + "長安漢朝" + "乙" * (C.BLOCK - 4) + "南陽郡長安"
    rows = spark.createDataFrame([("a", text), ("b", None), ("c", ""), ("d", "漢")], "sid string, text string")
    terms = [("長安", "LOCATION"), ("南陽郡", "LOCATION"), ("漢", "DYNASTY"), ("安漢", "LOCATION")]
    got = C.seed_candidates(rows, spark.createDataFrame(terms, "term string, label string"))
    want = {("a", i, i + len(t), t) for t, _ in terms for i in range(len(text)) if text.startswith(t, i)}
    found = [(r.sid, r.start, r.end, r.text) for r in got.collect()]
    assert sorted(found) == sorted(want)
    assert C.pattern_candidates(rows.where("sid <> 'a'")).count() == 0


def test_stream_yields_patterns_and_gazetteer(spark, tmp_path):
    from scriptorium.streaming.annotate import stream_candidates

    text = "高祖入漢，為太守。建武元年至長安城。《史記》曰。"
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("r1", text)], "id string, text string").write.mode("append").json(f"{tmp_path}/in")
    run = stream_candidates(spark, f"{tmp_path}/in").writeStream.format("memory").queryName("streamed").outputMode("append").option(
        "checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    assert run.awaitTermination(60)
    sents = G.sentences(spark.createDataFrame([("r1", text)], "id string, text string")).select("sid", "text")
    want = C.pattern_candidates(sents).unionByName(C.seed_candidates(sents, C.seed_terms(spark)))
    rows = lambda df: sorted((r.sid, r.start, r.end, r.label, r.source) for r in df.collect())
    got = rows(spark.table("streamed"))
    assert got == rows(want) and {r[4] for r in got} == {r.source for r in want.select("source").distinct().collect()} and len({r[4] for r in got}) == 2


def strict(spark, entities, cleaning="kept", scope="full", pilot=None):
    records = spark.createDataFrame([("r", "甲乙丙丁戊己", cleaning, 0)], "id string, text string, cleaning_status string, n_conflicts int")
    sents = spark.createDataFrame([("r", "s1", 1, 0, 6, "", "checked"), ("r", "s2", 2, 0, 6, "", "checked")], "id string, sid string, pos int, start int, end int, text string, review_status string")
    rows = [("r", f"e{k}", s, a, b, "甲乙丙丁戊己"[a:b], "PERSON", ["x"], "checked") for k, (s, a, b) in enumerate(entities)]
    ents = spark.createDataFrame(rows, "id string, eid string, sentence_id string, start int, end int, text string, label string, sources array<string>, review_status string")
    return sorted(r["code"] for r in V.strict_issues(records, sents, ents, scope, pilot).collect())


def test_strict_rules(spark):
    assert strict(spark, [("s1", 0, 4), ("s1", 1, 1), ("s1", 2, 5)]) == ["entity_overlap", "invalid_entity_span"]
    assert strict(spark, [("s1", 0, 3), ("s2", 1, 4)]) == [] and strict(spark, [("s1", 0, 3), ("s1", 3, 4)]) == []
    assert strict(spark, [], "dirty") == strict(spark, [], None) == ["cleaning_needs_review"] and strict(spark, [], "checked") == []
    assert strict(spark, [], "dirty", "final") == ["mapping_unconfirmed"] and strict(spark, [], "dirty", "pilot") == []
    assert strict(spark, [], "dirty", "pilot", spark.createDataFrame([("s1",)], "sentence_id string")) == ["cleaning_needs_review"]


def test_unknown_label_is_fatal(spark):
    rows = spark.createDataFrame([("PERSON",), ("THING",)], "label string")
    assert rows.limit(1).select(T.submission_label(F.col("label"), rules.LabelMapping())).first()[0] == "PER"
    with pytest.raises(Exception, match="no delivered label for THING"):
        rows.select(T.submission_label(F.col("label"), rules.LabelMapping())).collect()


def test_final_gates(spark):
    records = spark.createDataFrame([("r1", "漢書", "甲乙丙"), ("r2", "?", "甲")], "id string, title string, text string")
    with pytest.raises(ValueError, match="no work id"):
        X.with_work_ids(records, I.works(spark))
    assert X.with_work_ids(records.where("id = 'r1'"), I.works(spark)).first()["work_id"] == "HCH_006"
    e = "array<struct<text:string,label:string,start:int,end:int,review_status:string,linking_status:string>>"
    ann = spark.createDataFrame([("r1", "s1", 1, 0, "甲乙丙", "checked", "HCH_006", "01", [("甲乙", "PERSON", 0, 2, "checked", None), ("乙丙", "LOCATION", 1, 3, "checked", None)])],
                                f"id string, sid string, idx int, start int, text string, review_status string, work_id string, volume string, entities {e}")
    recs = records.where("id = 'r1'").selectExpr("id", "text", "'kept' AS cleaning_status", "0 AS n_conflicts")
    sents = ann.selectExpr("id", "sid", "start", "3 AS end", "review_status")
    ents = ann.selectExpr("id", "explode(entities) AS e").selectExpr("id", "concat('e', e.start) AS eid", "'s1' AS sentence_id", "e.start", "e.end", "e.text", "e.label", "array('human') AS sources", "e.review_status")
    mapping = rules.LabelMapping(confirmed=True)
    with pytest.raises(ValueError, match="fails validation.*entity_overlap"):
        X.final_rows(ann, ["idx"], recs, sents, ents, mapping)
    with pytest.raises(ValueError, match="break their rules.*entity_overlap"):
        X.final_rows(ann, ["idx"], recs, sents, ents.limit(1), mapping)
    one = ann.withColumn("entities", F.slice("entities", 1, 1))
    assert X.final_rows(one, ["idx"], recs, sents, ents.limit(1), mapping).first()["sentence_id"] == "HCH_006_01_000001"


def test_corpus_files(spark, tmp_path):
    from scriptorium.sources import corpus as S2

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/漢書_full.txt").write_text("漢書\n# 卷一\n漢朝太守。至長安城。\n\n# 卷二\n惠帝。\n", "utf-8")
    total = S2.prepare(I.read_lines(spark, str(tmp_path / "raw")), str(tmp_path / "out"), I.works(spark))
    assert (total["records"], total["works"], total["removed_lines"]) == (2, 1, {"work_title": 1, "heading": 2, "blank": 1})
    assert '"records": 2' in S2.read_text(spark, str(tmp_path / "out/statistics.json"))
    corpus = S2.read_rows(spark, str(tmp_path / "out/corpus"))
    sents = G.sentences(corpus.drop("sentences", "entities", "unresolved_conflicts"))
    K.write_seeds(str(tmp_path / "seeds.jsonl.gz"), rules.seeds(), "1", "CC0")
    people = spark.createDataFrame([("惠帝", [(1, 29)])], "name string, people array<struct<person_id:int,dynasty:int>>")
    K.write_table(people, str(tmp_path / "names"), "names", "1", "CC0")
    sources = S2.build_sources(spark, str(tmp_path / "seeds.jsonl.gz"), str(tmp_path / "names"), str(tmp_path / "missing"), "all", "off")
    assert [s.name for s in sources] == ["regex", "seed", "cbdb"]
    path = str(tmp_path / "annotated")
    S2.write_annotated(M.annotate(sents, S2.candidates(sources, sents)), path)
    back = S2.read_rows(spark, path)
    got = {(e["label"], e["text"]) for r in back.collect() for e in r["entities"]}
    assert ("PERSON", "惠帝") in got and ("OFFICIAL_TITLE", "太守") in got and {r["period"] for r in back.collect()} == {"西漢"}
    flat = S2.sentences_of(back)
    S2.write_review(flat.withColumnRenamed("id", "rid"), str(tmp_path / "review"))
    body = S2.import_review_files(spark, str(tmp_path / "review"), path, str(tmp_path / "gold"), strict=True)
    assert body["n_reviewed"] == 3 and body["n_updated"] == body["n_added"] == body["n_removed"] == 0
    for bad in ((path, path), (path, str(tmp_path / "gold")), (str(tmp_path / "none"), str(tmp_path / "g2"))):
        with pytest.raises(ValueError):
            S2.import_review_files(spark, str(tmp_path / "review"), *bad)
    S2.write_rows(spark.createDataFrame([("漢書_full-000001-s1", "另一", [["0", "9", "PERSON"]])], "id string, data string, label array<array<string>>"), str(tmp_path / "wrong"))
    with pytest.raises(ValueError, match="invalid_span"):
        S2.import_review_files(spark, str(tmp_path / "wrong"), path, str(tmp_path / "g3"))
    (tmp_path / "mixed").mkdir()
    (tmp_path / "mixed/a.jsonl").write_text('{"id": "a"}\n\n[1]\n{\n{"id": "b"}\n', "utf-8")
    rows, bad = S2.read_tolerant(spark, str(tmp_path / "mixed"), "id string")
    assert {r["id"] for r in rows.collect()} == {"a", "b"} and [r["line_no"] for r in bad.orderBy("line_no").collect()] == [3, 4]
    part = next((tmp_path / "names").glob("part-*"))
    part.write_bytes(part.read_bytes() + b"x")
    assert [s.name for s in S2.build_sources(spark, names=str(tmp_path / "names"))] == ["regex"]


def test_entity_shapes_and_pilot_ids(spark):
    e = "array<struct<start:int,end:int,label:string,sentence_id:string>>"
    records = spark.createDataFrame([([("s",)], [(0, 1, "A", "s")])], f"sentences array<struct<sid:string>>, entities {e}")
    sents = spark.createDataFrame([("", "s", [(0, 1, "A", None)])], f"sentence_id string, sid string, entities {e}")
    flat = spark.createDataFrame([("s", 0, 1, "A")], "sentence_id string, start int, end int, label string")
    assert [E.entities_of(x).collect() for x in (records, sents)] == [flat.collect()] * 2 and E.entities_of(flat).count() == 1
    ids = spark.createDataFrame([("", "a"), ("b", "c"), (None, None)], "sentence_id string, sid string")
    with pytest.raises(ValueError):
        E.pilot_ids(ids)
    assert {r[0] for r in E.pilot_ids(ids, "ignore").collect()} == {"a", "b"}


def test_dictionary_by_join_equals_automaton(spark):
    rows = spark.createDataFrame([("a", "長安漢朝安漢"), ("b", None), ("c", "漢" * 9)], "sid string, text string")
    terms = spark.createDataFrame([("長安", 1), ("漢", 2), ("漢漢", 3), ("漢", 4), ("", 5)], "term string, k int")
    got = [sorted(map(tuple, C.dictionary_matches(rows, terms, n).select("sid", "k", "start", "end", "pos", "near", "match").collect())) for n in (100, 0)]
    assert got[0] == got[1] and len(got[0]) == 1 + 2 * 11 + 8


def test_pilot_manifest_and_page(spark):
    rows = spark.createDataFrame([(f"{t}{k}", t) for t in "ab" for k in range(5)], "sid string, title string")
    a, b = rows.where("title = 'a'"), rows.where("title = 'b'")
    assert S.pilot_manifest(a, b, 5)["work_quota"] == {"a": 5}
    with pytest.raises(ValueError):
        S.pilot_manifest(a, rows, 5)
    card = {"title": "t", "sid": "s", "text": "漢", "entities": [{"start": 0, "end": 1, "label": "DYNASTY"}],
            "conflicts": [{"kind": "same_span_label", "candidates": [{"label": "<x>", "start": 0, "end": 1, "source": "seed"}, {"label": "B", "start": 0, "end": 1, "sources": ["regex"]}]}]}
    got = X.page([card])
    assert "same_span_label" in got and "&lt;x&gt;" in got and 'class="on">DYNASTY' in got and 'class="off">PERSON' in got
