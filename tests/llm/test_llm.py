"""Training-data operators against brute force, exact round trips and edge cases."""

import hashlib
import random
import zlib
from collections import Counter
from math import comb, log2, log10

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.llm import chat_format, common, decontam, fm_classifier, line_dedup, lm_score, packing, quality_rules, simhash, token_coder, tokenizing, warc
from scriptorium.llm.queries import vocabulary

DOC = "doc_id long, text string, lang string, source string, n_chars long, uid string, score int"


def docs(spark, texts, ids=None):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(ids[k] if ids else k, t, "en", "s", 0, "u", 1) for k, t in enumerate(texts)], DOC)


def prose(rng, n, vocabulary_=400):
    return " ".join(f"w{rng.randrange(vocabulary_)}" for _ in range(n))


ODD = ["", None, "a", "  a  b", "l'été's ÉCOLE 12ab!?'ll", "x \n y", "\n", "日本語 text 'S", "a\x1cb c\x85d", "tab\there", "<|endoftext|> x", "a<|endoftext|>b <|ENDOFTEXT|>", "<|startoftext|>",
       "a  " + "b " * 300, "word " * 5000 + "<|endoftext|>"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(name):
    from tokenizers import Tokenizer

    enc, library = tokenizing.encoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
    for t in ODD:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, (1 << 20) - 1), max_size=300), st.integers(1, 40))
def test_coder_round_trip(ids, repeat):
    a = np.array(ids * repeat, np.uint32)
    words, sizes, checks, above = token_coder.pack(a)
    assert (token_coder.unpack(words, sizes, checks, above, len(a)) == a).all()


def test_coder_rejects_damage():
    a = np.arange(5000, dtype=np.uint32) % 977
    words, sizes, checks, above = token_coder.pack(a)
    words[3] ^= 1
    with pytest.raises(ValueError):
        token_coder.unpack(words, sizes, checks, above, len(a))


def test_blocks_are_coded_independently():
    rng = np.random.default_rng(3)
    a = (rng.zipf(1.3, 3 * token_coder.BLOCK) % 900).astype(np.uint32)
    a[:: token_coder.BLOCK] = 900  # the number above all ids is a parameter of the file
    words, sizes, _, _ = token_coder.pack(a)
    alone = [token_coder.pack(a[k : k + token_coder.BLOCK])[0].tolist() for k in range(0, len(a), token_coder.BLOCK)]
    assert [x.tolist() for x in np.split(words, np.cumsum(sizes)[:-1])] == alone
    assert token_coder.pack(np.full(4096, 7, np.uint32))[0].nbytes < 200  # order 2 learns within a block


def test_token_files(spark):
    texts = [*ODD, "same", "same"]
    ids = [*range(len(ODD)), 50, 50]
    got = token_coder.encode_corpus(docs(spark, texts, ids), vocabulary("word_bpe_49k.json")).orderBy("start").collect()
    enc, at = tokenizing.encoder(vocabulary("word_bpe_49k.json")), 0
    for r, (k, t) in zip(got, zip(ids, texts)):
        want = enc.ids(t) + b"\1\0\0\0"
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (k, at, len(want) // 4, zlib.crc32(want))
        at += len(want) // 4
    assert token_coder.encode_corpus(docs(spark, []), vocabulary("word_bpe_49k.json")).count() == 0


def test_token_files_encode_batches():
    """op1: ids of a batch are the library's, and letters with a mark behind them are looked up as units, not kept as words."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        enc, library = tokenizing.Encoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
        more = ["<|", "<|x", "a\x0bb\x0cc\rd e\u2003f", "it's they'll we'd' 'tis rock'n'roll _a a_ 1a a1", "\u0130I \u017ft K\u212a", "e\u0301 a\u0301x,"]
        for texts in (ODD + more, (ODD + more)[::-1], [None, ""], ["<|endoftext|>"] * 3, []):
            want = [library.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
            ids, counts = enc.batch(pa.array(texts, pa.string()), 7)
            assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
        sliced = pa.array(["x", *ODD, None], pa.string()).slice(1)
        assert enc.batch(sliced, 7)[0].tolist() == sum([library.encode(t or "", add_special_tokens=False).ids + [7] for t in [*ODD, None]], [])
    enc = tokenizing.Encoder(vocabulary("word_bpe_49k.json"))
    long = ["a b, " * 140_000, "<|x", None, "c " * 300_000, "d"]  # longer than what is expanded at a time
    for kind in (pa.string(), pa.large_string()):
        ids, counts = enc.batch(pa.array(long, kind), 1)
        assert ids.tobytes() == b"".join(enc.ids(t) + b"\1\0\0\0" for t in long)
        assert counts.tolist() == [len(enc.ids(t)) // 4 + 1 for t in long]
    enc = tokenizing.Encoder(vocabulary("word_bpe_49k.json"))
    enc.batch(pa.array(["Words words, WORDS. \u00c9t\u00e9! \u00e9t\u00e9", "words 2b"]), 7)
    assert set(enc.plain) == {"2b"} and {"words", "\u00e9t\u00e9"} < set(enc.pieces)


def test_coder_refreshes_order_0():
    """op1: blocks of few, many and only new ids in one shard; any damaged word is a checksum error, nothing else."""
    rng = np.random.default_rng(5)
    n = token_coder.BLOCK
    a = np.concatenate([np.arange(n), rng.integers(0, 3, n), (rng.zipf(1.2, n) % 49_000), np.full(n, 5), rng.permutation(n)[: n // 3]]).astype(np.uint32)
    words, sizes, checks, above = token_coder.pack(a)
    assert (token_coder.unpack(words, sizes, checks, above, len(a)) == a).all()
    for k in rng.integers(0, len(words), 12):
        bad = words.copy()
        bad[k] ^= 0xA5A5A5A5
        with pytest.raises(ValueError):
            token_coder.unpack(bad, sizes, checks, above, len(a))
    few = (np.random.default_rng(9).zipf(1.3, 2 * n) % 900).astype(np.uint32)
    assert token_coder.pack(few)[0].nbytes * 8 / len(few) < 6.65  # 6.67 with order-0 counts of every step


def test_shards_are_cut_at_documents(spark, monkeypatch):
    """op1: many shards in a partition hold whole documents in order; a null doc_id and large ones stay exact."""
    monkeypatch.setattr(token_coder, "SHARD_IDS", 7)
    texts, ids = ["a b c", "", "d " * 20, None, "e f g h i j k", "l", "m n"], [1, 2, (1 << 62) + 1, 4, 5, None, 7]
    got = token_coder.encode_corpus(docs(spark, texts, ids), vocabulary("word_bpe_49k.json")).orderBy("start").collect()
    enc, at = tokenizing.encoder(vocabulary("word_bpe_49k.json")), 0
    for r, (k, t) in zip(got, sorted(zip(ids, texts), key=lambda p: -1 if p[0] is None else p[0]), strict=True):
        want = enc.ids(t) + b"\1\0\0\0"
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (k, at, len(want) // 4, zlib.crc32(want))
        at += len(want) // 4


def brute_rules(text):
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i, t in enumerate(zip(w, w[1:], w[2:])) if tri[t] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark):
    rng = random.Random(3)
    texts = [prose(rng, 80) for _ in range(60)] + [prose(rng, 60) + " ###" * 40 for _ in range(30)] + ["a b c a b c x", "x\nx\n y\nx", "é " * 70, "", None, prose(rng, 3000, 12)]
    d = docs(spark, texts)
    labels = spark.createDataFrame([(k, int(k < 60), 0) for k in range(90)] + [(3, 1, 0), (999, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(d, labels, risk=0.3, delta=0.3).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_rules(t)
        n, _, _, _, rep = brute_rules(t)
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n) and not (r["base_failed"] and r["kept"])
    assert all(got[k]["kept"] for k in range(60)) and not any(got[k]["kept"] for k in range(60, 90))
    assert quality_rules.apply_rules(d.limit(0), labels.limit(0)).count() == 0


def brute_thresholds(spark, rows, labels, risk, delta):
    """(stratum, cutoffs) by the definition; rows: doc_id, stratum, ratios by rule."""
    q = quality_rules
    ids = sorted({r[0] for r in rows if r[0] is not None})
    part = {r["i"]: r["t"] for r in spark.createDataFrame([(i,) for i in ids], "i long").select("i", (F.pmod(F.xxhash64("i"), F.lit(3)) == 0).alias("t")).collect()}
    mark = {}
    for i, y, _ in labels:
        if y in (0, 1):
            mark[i] = max(y, mark.get(i, 0))
    held = [(part[i], s, v, mark[i]) for i, s, v in rows if i in mark]
    strata = {s for t, s, _, _ in held if not t and any(u and z == s for u, z, _, _ in held)}
    out = {}
    for s in strata:
        side = lambda t, y: [v for u, z, v, x in held if (u, z, x) == (t, s, y)]
        good, bad = side(True, 1), side(True, 0)
        rate = lambda vs, f: sum(map(f, vs)) / max(1, len(vs))
        best, n = None, len(side(False, 1))
        for t, budget in enumerate(q.BUDGETS):
            cut = {}
            for r in q.RULES:
                pay = [c for c in q.GRID[r] if rate(good, lambda v, c=c: v[r] > c) <= budget / 4 and rate(bad, lambda v, c=c: v[r] > c) > 4 * rate(good, lambda v, c=c: v[r] > c)]
                cut[r] = min(pay, default=None)
            hit = lambda v: any(c is not None and v[r] > c for r, c in cut.items())
            k = sum(map(hit, side(False, 1)))
            if not n or sum(comb(n, j) * risk**j * (1 - risk) ** (n - j) for j in range(k + 1)) > delta / len(strata):
                break
            gain = (rate(side(False, 0), hit) - 4 * k / n, -t)
            if best is None or gain > best[0]:
                best = gain, cut
        out[s] = best[1] if best else dict.fromkeys(q.RULES)
    return out


def test_quality_rules_certify(spark):
    rng = random.Random(17)
    texts, marks, strata = [], [], []
    for k in range(700):
        lang = "en" if k % 7 else "de"
        good = rng.random() < 0.8
        t = prose(rng, rng.randrange(55, 90), 5000)
        if not good and rng.random() < 0.7 or rng.random() < 0.02:
            t = rng.choice((t.replace(" ", " ## ", 30), "\n".join([t, *["same line of words here"] * 6]), t.replace("w", "wwwwwwwwwwwwwww")))
        texts.append(t), marks.append((k, int(good), 0)), strata.append(lang)
    d = spark.createDataFrame([(k, t, s) for k, (t, s) in enumerate(zip(texts, strata))], "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    measured = quality_rules.features(d, "doc_id", "lang").withColumn("base_failed", F.lit(False))
    rows = [(r["doc_id"], r["lang"], {n: r[n] for n in quality_rules.RULES}) for r in measured.select("doc_id", "lang", *[c.alias(n) for n, c in quality_rules.ratios().items()]).collect()]
    got = {r["lang"]: r for r in quality_rules.thresholds(measured, labels).collect()}
    want = brute_thresholds(spark, rows, marks, quality_rules.RISK, quality_rules.DELTA)
    assert {s: {n: r[f"max_{n}"] for n in quality_rules.RULES} for s, r in got.items()} == want
    assert any(v is not None for v in want["en"].values()) and not any(v is not None for v in want["de"].values())
    out = {r["doc_id"]: r for r in quality_rules.apply_rules(d, labels).collect()}
    for i, s, v in rows:
        broken = [n for n in quality_rules.RULES if want[s][n] is not None and v[n] > want[s][n]]
        assert out[i]["kept"] == (not out[i]["base_failed"] and not broken) and (out[i]["base_failed"] or out[i]["rule"] == (broken or [None])[0])


def test_binomial_tail(spark):
    rows = [(k, n) for n in (1, 5, 40, 3000) for k in (0, 1, 3, 40) if k <= n]
    got = spark.createDataFrame(rows, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).collect()
    for r in got:
        want = min(1.0, sum(comb(r["n"], j) * 0.02**j * 0.98 ** (r["n"] - j) for j in range(r["k"] + 1)))
        assert r["p"] == pytest.approx(want, rel=1e-9)


@given(st.text(alphabet="<|\\>ai\n"))
def test_escape_is_reversible(t):
    e = chat_format.escape(t)
    assert chat_format.unescape(e) == t and "<|" not in e and chat_format.unescape_role(chat_format.escape_role(t)) == t


def test_chat(spark):
    rows = [(1, 0, "user", "<|im_end|>"), (1, 1, "assistant", "hé <|x"), (2, 0, "assistant", "no"), (2, 1, None, None), (None, 0, "user", "q"), (1, 2, "user", ""), (1, 3, "assistant", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("state", F.lit("x"))
    got = {r["conv_id"]: r for r in chat_format.format_conversations(table).collect()}
    want = hashlib.sha256("user\n<|im_end|>\nassistant\nhé <|x\nuser\n\nassistant\n\n".encode()).hexdigest()
    assert (got[1]["n_turns"], got[1]["turns_sha256"], got[1]["loss_chars"], got[1]["valid"]) == (4, want, 6, True)
    assert got[1]["loss_sha256"] == hashlib.sha256("hé <|x".encode()).hexdigest()
    assert not got[2]["valid"] and not got[None]["valid"]
    assert chat_format.format_conversations(table.limit(0)).count() == 0


def test_warc(spark, tmp_path):
    rows = [(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "u v", ""), (5, "é", "yé" * 500), (5, "é", "yé" * 500), (None, "n", "only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("revisit", F.lit(7))
    got = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archive(pages, 0, f"file://{tmp_path}/a").collect()}
    assert got == {(1, "revisit", 2, 1), (2, "response", None, 1), (3, "revisit", 4, 0), (4, "response", None, 0), (5, "response", None, 1500), (None, "response", None, 4)}
    warc.write_warc(pages.repartition(3), f"file://{tmp_path}/b", 0)
    digest = lambda d: {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in (tmp_path / d).glob("*.gz")}
    assert digest("a") == digest("b") and digest("a") and not (tmp_path / "a/_temporary").exists()
    assert warc.archive(pages.limit(0)).count() == 0


def test_warc_shards_of_uneven_ids(spark):
    rng = random.Random(11)
    ids = [-(2**62), 2**62, 7, 7, 7, 7] + [rng.randrange(5000) for _ in range(400)]
    pages = spark.createDataFrame([(p, "u", "x" * (40_000 if p == 7 else rng.randrange(900))) for p in ids], "page_id long, url string, html string")
    bounds, shards = warc._bounds(pages, 20_000)
    held = Counter()
    for p, html in pages.select("page_id", "html").collect():
        held[sum(b < p for b in bounds)] += len(html) + 600
    hot = sum(b < 7 for b in bounds)
    assert bounds == sorted(set(bounds)) and shards == len(bounds) + 1 > 15
    assert all(v < 40_000 for k, v in held.items() if k != hot)
    out = warc.archive(pages, 0).collect()
    assert sorted(r["page_id"] for r in out) == sorted(ids)


def test_warc_record_ids_are_unique(spark, tmp_path):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "b", "y"), (2, "c", "x"), (2, "c", "z"), (None, "d", "z"), (None, "d", "z")]
    manifest = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/w")
    heads = []
    for r in manifest.collect():
        with open(tmp_path / "w" / r["name"], "rb") as f:
            heads += [h for h, _ in warc.read_records(f)]
    ids = [h["WARC-Record-ID"] for h in heads]
    assert len(ids) == len(set(ids)) == len(rows)
    assert all(h["WARC-Refers-To"] in ids for h in heads if h["WARC-Type"] == "revisit")


def test_packing(spark):
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(1, 500)) for _ in range(60)] + [prose(rng, 3000), "", None, "same", "same"]
    got = packing.pack_documents(docs(spark, texts), vocabulary("byte_bpe_50k.json")).collect()
    enc = tokenizing.encoder(vocabulary("byte_bpe_50k.json"))
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for k, t in enumerate(texts):
        ids, at = enc.ids(t) + b"\2\0\0\0", 0
        for r in sorted(by[k], key=lambda r: r["piece"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[4 * at : 4 * (at + r["length"])])
            assert r["length"] == 1024 or r["piece"] == 0
            at += r["length"]
        assert at == len(ids) // 4
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(n for _, n in s) <= 1024
    assert len(seqs) <= 1.1 * sum(r["length"] for r in got) / 1024 + 1
    assert packing.pack_documents(docs(spark, []), vocabulary("byte_bpe_50k.json")).count() == 0


def test_crossover_keeps_documents():
    rng = random.Random(1)
    size = [rng.randrange(1, 1024) for _ in range(300)]
    a = packing.best_fit([], list(range(300)), size, 1024)
    b = packing.best_fit([], sorted(range(300), key=lambda i: -size[i]), size, 1024)
    c = packing.crossover(a, b, size, 1024, rng)
    assert sorted(i for x in c for i in x) == list(range(300)) and all(sum(size[i] for i in x) <= 1024 for x in c)
    assert len(packing.evolve(size, [], 1024, 1)) <= len(b)


def brute_leaks(texts, items):
    words = lambda t: (t or "").encode().lower().decode().split()
    sh = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    out = set()
    for i, item in items:
        b = words(item)
        if not b:
            continue
        k = min(5, len(b))
        want = Counter(sh(b, k))
        for d, t in enumerate(texts):
            s = sh(words(t), k)
            n = sum(want.values())
            for at in range(max(1, len(s) - n + 1)):
                own = Counter(s[at : at + n])
                if own and sum((own & want).values()) >= 0.8 * sum((own | want).values()):
                    out.add((d, i))
    return out


def test_decontamination(spark):
    rng = random.Random(8)
    items = [(k, prose(rng, n)) for k, n in enumerate((30, 45, 60, 3, 5, 12))] + [(6, ""), (7, None), (8, "t t t t t t t t t t t t")]
    texts = []
    for k in range(40):
        w = prose(rng, rng.randrange(5, 200)).split()
        p = items[k % 6][1].split()
        if k % 3 == 0:
            q = list(p)
            if k % 2 and len(q) > 20:
                q[rng.choice((0, 2, len(q) - 1))] = "changed"
            w[len(w) // 2 : len(w) // 2] = q
        elif k % 3 == 1:
            w += p[: len(p) // 2]
        texts.append(" ".join(w).upper() if k % 5 == 0 else " ".join(w))
    texts += ["t " * 20, "", None, items[0][1], items[0][1]]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs(spark, texts), bench).collect()}
    assert got == brute_leaks(texts, items)
    assert decontam.leaks(docs(spark, []), bench).count() == 0 and decontam.leaks(docs(spark, texts[:3]), bench.limit(0)).count() == 0


def test_decontamination_of_truncated_items(spark):
    rng = random.Random(21)
    items = [(k, prose(rng, n)) for k, n in enumerate((50, 80, 120))]
    texts = [" ".join(p.split()[:n]) for _, p in items for n in (len(p.split()) * x // 100 for x in (76, 80, 84, 88, 94))]
    texts += [" ".join(items[0][1].split()[6:]), " ".join(items[0][1].split()[:44]) + " x", " ".join(items[1][1].split()[3:75])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs(spark, texts), bench).collect()}
    assert got == brute_leaks(texts, items) and len(got) >= 12


def test_language_model(spark, monkeypatch):
    rng = random.Random(2)
    texts = [prose(rng, rng.randrange(0, 60), 30) for _ in range(60)] + ["", None, "A a A"]
    fixed = np.ones((lm_score.N_BUCKETS, 4)) / 4 + np.arange(lm_score.N_BUCKETS)[:, None] * [[0.001, 0.002, -0.001, -0.002]]
    monkeypatch.setattr(lm_score, "learn_weights", lambda *a, **k: fixed)
    monkeypatch.setattr(lm_score, "CHUNK", 300)
    monkeypatch.setattr(lm_score, "SLICE", 70)
    monkeypatch.setattr(lm_score, "BUCKET_KEYS", 500)
    got = {r["doc_id"]: r for r in lm_score.score_corpus(docs(spark, texts)).collect()}
    seqs = [(t or "").lower().split() + ["</s>"] for t in texts]
    held = [zlib.crc32(str(k).encode()) % 7 == 2 for k in range(len(texts))]
    c1, c2, c3 = Counter(), Counter(), Counter()
    n_docs = 0
    for s, h in zip(seqs, held):
        if not h:
            n_docs += 1
            p = ["<s>", *s]
            c1.update(s), c2.update(zip(p, p[1:])), c3.update(zip(p, p[1:], p[2:]))
    n, v = sum(c1.values()), len(c1)
    for k, s in enumerate(seqs):
        base = sum(log10((c1[w] + 1) / (n + v + 1)) for w in s)
        score, p = 0.0, ["<s>", *s]
        for j, w in enumerate(s):
            x2 = n_docs if j == 0 else c1[p[j]]
            x3 = 0 if j == 0 else c2[p[j - 1], p[j]]
            e = [1 / (v + 1), c1[w] / n, c2[p[j], w] / x2 if x2 else 0, c3[p[j - 1], p[j], w] / x3 if x3 else 0]
            b = 17 + min(15, int(log2(x3))) if x3 else 1 + min(15, int(log2(x2))) if x2 else 0
            score += log10(sum(a * q for a, q in zip(fixed[b], e)))
        r = got[k]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[k], len(s), sum(c1[w] > 0 for w in s), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)


def test_language_model_learns(spark):
    rng = random.Random(4)
    cycle = "the cat sat on the mat and then the dog ran to the red house".split()
    texts = [" ".join(cycle[rng.randrange(5) :] * rng.randrange(1, 4)) for _ in range(150)]
    rows = lm_score.score_corpus(docs(spark, texts)).collect()
    assert sum(r["score"] for r in rows if r["held_out"]) > 0.5 * sum(r["base_score"] for r in rows if r["held_out"])
    assert lm_score.score_corpus(docs(spark, [])).count() == 0


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(spark):
    rng = random.Random(6)
    base = [prose(rng, 150) for _ in range(12)]
    texts = list(base)
    for t in base:
        for _ in range(4):
            w = t.split()
            w[rng.randrange(len(w))] = "new"
            texts.append(" ".join(w))
    texts += ["", None, " \n", "one", "one two", "ONE two", base[0]]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    for k in range(len(texts)):
        assert got[k]["fingerprint"] == f"{fps[k]:016x}" and got[k]["component_id"] == root(k)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 5, 7])
def test_links_find_every_pair(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(9))) for b in base for _ in range(8)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), radius).collect()}
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
    assert got == want


def test_links_never_broadcast_the_index(spark):
    fps = common.stage(spark.range(50).select(F.xxhash64("id").alias("fp")), "few")  # small, and known to be so
    plan = simhash.links(fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def brute_lines(texts, least):
    seq = [(d, i, s) for d, t in enumerate(texts) if t is not None for i, s in enumerate(t.split("\n")) if s.strip()]
    gone = set()
    for x in range(len(seq)):
        for y in range(x):
            k = words = 0
            while x + k < len(seq) and seq[x + k][0] == seq[x][0] and y + k < len(seq) and seq[y + k][0] == seq[y][0] and seq[x + k][2] == seq[y + k][2]:
                words += len(seq[x + k][2].split())
                k += 1
            if words >= least:
                gone |= {seq[x + j][:2] for j in range(k)}
    return gone


def test_line_dedup(spark):
    rng = random.Random(9)
    lines = [prose(rng, rng.randrange(1, 14)) for _ in range(30)]
    texts = []
    for _ in range(25):
        t = [rng.choice(lines) for _ in range(rng.randrange(1, 12))]
        a = rng.randrange(20)
        texts.append("\n".join([*t, *lines[a : a + rng.randrange(2, 9)], "", *t[:2]]))
    texts += [None, "", "\n\n", texts[0], "x\n" * 40]
    got = line_dedup.dedup_lines(docs(spark, texts), 20).collect()
    removed = {(r["doc_id"], i) for r in got for i in r["removed"]}
    assert removed == brute_lines(texts, 20)
    for r in got:
        own = texts[r["doc_id"]]
        if not r["removed"]:
            assert r["text"] == own
        else:
            kept = [s for i, s in enumerate(own.split("\n")) if i not in r["removed"]]
            assert r["text"] == ("\n".join(kept) if any(s.strip() for s in kept) else "")
        assert r["uid"] == "u"
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_of_repeated_and_tied_rows(spark):
    rng = random.Random(19)
    a, b, c = (prose(rng, 30) for _ in range(3))
    rows = [(None, f"{a}\nx"), (None, f"{a}\nx"), (1, f"{a}\n\n{b}"), (1, f"{b}\n{c}"), (1, f"{a}\n\n{b}"), (2, "short\nshort"), (2, "short\nshort"), (3, None), (3, None), (4, "\n".join([a] * 4))]
    table = spark.createDataFrame([(i, t, k, "u", "s") for k, (i, t) in enumerate(rows)], "doc_id long, text string, __uid long, th string, gone string")
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "", r["n_removed"]) for r in line_dedup.dedup_lines(table, 20).collect())
    assert got == sorted([(-1, f"{a}\nx", 0), (-1, "", 2), (1, f"\n{b}", 1), (1, c, 1), (1, "", 2), (2, "short\nshort", 0), (2, "short\nshort", 0), (3, "", 0), (3, "", 0), (4, "", 4)])
    assert set(table.columns) <= set(line_dedup.dedup_lines(table, 20).columns)
    assert sorted(r["__uid"] for r in line_dedup.dedup_lines(table, 20).collect()) == list(range(len(rows)))


def test_caches_belong_to_one_operator():
    """A worker that goes from one operator to the next keeps no word of the last one."""
    tokenizing.encoder(vocabulary("byte_bpe_50k.json")).ids("some words of a text")
    assert tokenizing._ENCODERS
    common.hold("near")
    assert not tokenizing._ENCODERS
    fm_classifier._own()
    fm_classifier.features("some words of a text")
    fm_classifier._own()
    assert fm_classifier._BUCKETS  # its own tasks share them
    tokenizing.encoder(vocabulary("byte_bpe_50k.json"))
    assert not fm_classifier._BUCKETS and tokenizing._ENCODERS


def test_sieve(spark):
    keys = spark.createDataFrame([(k * 7919 - 50_000_000,) for k in range(20_000)] + [(None,), (-1,), (2**63 - 1,), (-(2**63),)], "k long")
    test = common.sieve(keys, "k")
    assert keys.where("k IS NOT NULL").where(~test(F.col("k"))).count() == 0
    assert spark.range(10**9, 10**9 + 20_000).where(test(F.col("id"))).count() < 100


def test_factorisation_machine(spark):
    rng = np.random.default_rng(0)
    m = fm_classifier.Model(0.1, rng.normal(size=fm_classifier.N_FEATURES), rng.normal(size=(fm_classifier.N_FEATURES, 4)))
    at, x = np.array([3, 70, 900]), np.array([0.5, -1.0, 2.0])
    z = 0.1 + m.weights[at] @ x + sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(3) for j in range(i))
    assert m.score(at, x) == pytest.approx(1 / (1 + np.exp(-z)))
    r = random.Random(1)
    texts = [prose(r, 60) if k % 3 else prose(r, 60).replace(" ", "### ") for k in range(150)] + ["", None]
    d = docs(spark, texts)
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(150)] + [(7, None, 0)], "doc_id long, quality int, toxic int")
    model = fm_classifier.fit(d, fm_classifier.marks_of(labels, F.col("doc_id") % 2 == 0))
    got = {r["doc_id"]: r["score"] for r in fm_classifier.score(d.drop("score"), model).collect()}
    assert sum((got[k] >= 0.5) == (k % 3 > 0) for k in range(1, 150, 2)) >= 73 and all(0 <= s <= 1 for s in got.values()) and len(got) == 152
    empty = fm_classifier.fit(d, fm_classifier.marks_of(labels.limit(0)))
    assert all(r["score"] == pytest.approx(0.5) for r in fm_classifier.score(d.drop("score"), empty).limit(3).collect())


def test_pipeline_near_stage(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(12)
    base = [prose(rng, 200) for _ in range(6)]
    texts = [*base, base[0], base[1].replace(" w", " W", 1), base[2] + " tail", prose(rng, 200), None]
    d = docs(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    kept = sorted(r["doc_id"] for r in cp.near(spark, d, "").collect())
    assert kept == [0, 1, 2, 3, 4, 5, 9, 10]
    assert cp.near(spark, d, "").columns == d.columns


def brute_near(texts, words=5, similarity=0.8):
    """Indexes that stay: the smallest of each component of pairs with the similarity."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))})
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    return sorted(set(label))


def edited(rng, text, n):
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def test_pipeline_near_stage_finds_every_pair(spark, monkeypatch):
    import corpus_pipeline as cp
    from scriptorium.llm import near_copies

    rng = random.Random(31)
    base = [prose(rng, n) for n in (8, 40, 150, 150, 400, 1200)]
    texts = [*base]
    for t in base:
        n = len(t.split())
        texts += [edited(rng, t, max(1, round(n * x))) for x in (0.012, 0.018, 0.02, 0.021, 0.022, 0.024, 0.03)]
        texts += [" ".join(t.split()[: round(n * x)]) for x in (0.78, 0.82, 0.9)] + [t.upper().replace(" ", "  ", 1)]
    texts += [edited(rng, base[2], 2) for _ in range(30)] + ["", None, " \n", "one", "ONE", "one two"]
    d = docs(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    want = brute_near(texts)
    monkeypatch.setattr(near_copies, "SAMPLE", 2)  # frequent shingles known and unknown
    assert sorted(r["doc_id"] for r in cp.near(spark, d, "").collect()) == want
    assert cp.near(spark, d.limit(0), "").count() == 0


def test_pipeline_near_stage_goes_by_simhash(spark, monkeypatch):
    """Copies within the radius are found by fingerprints; the prefix filter gets no pair that they have joined."""
    import corpus_pipeline as cp
    from scriptorium.llm import near_copies

    rng = random.Random(33)
    base = [prose(rng, 1500, 10**5) for _ in range(4)]
    texts = [*base, *[edited(rng, t, 1) for t in base], *[edited(rng, t, 1) for t in base], prose(rng, 80)]
    fps = [simhash.fingerprint(t) for t in texts]
    want = {(i, j) for j in range(13) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= near_copies.RADIUS}
    assert len(want) >= 8
    sets = spark.createDataFrame([(k, f - (1 << 64) if f >> 63 else f) for k, f in enumerate(fps)], "g long, fp long")
    proposed = {(r["a"], r["b"]) for r in near_copies.by_fingerprint(sets).collect()}
    assert proposed <= want and common.connected_components(near_copies.by_fingerprint(sets)).count() == len({x for p in want for x in p})
    seen, verified = [], near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *a: seen.append({(r["a"], r["b"]) for r in pairs.collect()}) or verified(pairs, *a))
    d = docs(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    assert sorted(r["doc_id"] for r in cp.near(spark, d, "").collect()) == brute_near(texts) == [0, 1, 2, 3, 12]
    assert len(seen) == 3 and len(seen[0]) == len(proposed) and not seen[0] & (seen[1] | seen[2])


def test_pipeline_near_stage_keeps_texts_of_equal_fingerprints(spark):
    import corpus_pipeline as cp

    rng = random.Random(32)
    texts = ["a " * 200 + prose(rng, 150, 10**6) for _ in range(3)]
    assert len({simhash.fingerprint(t, 5) for t in texts}) == 1
    texts += [edited(rng, texts[1], 1), "a " * 90 + texts[2]]
    d = docs(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    assert sorted(r["doc_id"] for r in cp.near(spark, d, "").collect()) == brute_near(texts) == [0, 1, 2]


def test_quality_query(spark, tmp_path):
    """op10: folds, held_out and predicted as the query states them; labels of held-out rows change nothing."""
    from scriptorium.llm.queries import op10_quality_classifier

    rng = random.Random(44)
    good = [rng.random() < 0.6 for _ in range(150)]
    texts = [prose(rng, 60) if g else prose(rng, 60).replace(" ", "### ") for g in good]
    spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)] + [(None, None, "en", "s", 0), (200, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/a/documents.parquet")
    held = [zlib.crc32(str(k).encode()) % 3 == 1 for k in range(150)]
    for name, flip in (("a", False), ("b", True)):
        rows = [(k, int(g) ^ int(flip and h), 0) for k, (g, h) in enumerate(zip(good, held))]
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    spark.read.parquet(f"{tmp_path}/a/documents.parquet").write.parquet(f"{tmp_path}/b/documents.parquet")
    got = [sorted(map(tuple, op10_quality_classifier(spark, f"{tmp_path}/{x}").select("doc_id", "held_out", "score", "predicted").collect()), key=str) for x in "ab"]
    assert got[0] == got[1] and len(got[0]) == 152
    for k, h, score, predicted in got[0]:
        assert 0 <= score <= 1 and predicted == int(score >= 0.5) and h == (zlib.crc32(("" if k is None else str(k)).encode()) % 3 == 1)
    right = [good[k] == p for k, h, _, p in got[0] if h and k is not None and k < 150]
    assert sum(right) >= 0.9 * len(right)


def test_pipeline_run_equals_brute_force(spark, tmp_path):
    """All stages on a fixture with repeated runs, near copies, leaks, nulls and clashing columns; then on empty tables."""
    import corpus_pipeline as cp

    rng = random.Random(77)
    text = lambda n: prose(rng, n, 4000)
    run, items = "\n".join(text(30) for _ in range(3)), [(0, text(40)), (1, text(25))]
    texts = [text(rng.randrange(80, 160)) for _ in range(60)] + [text(70).replace(" ", " ### ", 60) for _ in range(20)]
    texts += [f"{text(60)}\n{run}", f"{run}\n{text(80)}", run, edited(rng, texts[0], 1), texts[1], f"{texts[2]} {items[0][1]}", " ".join(items[1][1].split()[:24]), text(2000), "", None, " "]
    rows = [(k, t, "en", "s", len(t or ""), k, k) for k, t in enumerate(texts)] + [(None, texts[3], "en", "s", 1, 0, 0), (5, texts[5], "en", "s", 1, 0, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, left int, score int").withColumn("n_chars", F.col("n_chars").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k < 60), 0) for k in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = fm_classifier.fit(read, fm_classifier.marks_of(spark.read.parquet(f"{tmp_path}/labels.parquet")))
    now = sorted(((r[0], r[1]) for r in rows if model.score(*fm_classifier.features(r[1])) >= 0.5), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert 50 < len(now) < 85
    gone = brute_lines([t for _, t in now], 50)
    cut = []
    for d, (k, t) in enumerate(now):
        own = [i for x, i in gone if x == d]
        kept = [s for i, s in enumerate((t or "").split("\n")) if i not in own]
        if not own or any(s.strip() for s in kept):
            cut.append((k, "\n".join(kept) if own else t))
    now = [cut[i] for i in brute_near([t for _, t in cut])]
    bad = {d for d, _ in brute_leaks([t for _, t in now], items)}
    now = [r for d, r in enumerate(now) if d not in bad]
    enc, want = tokenizing.encoder(vocabulary("byte_bpe_50k.json")), {}
    for k, t in now:
        ids = enc.ids(t) + b"\2\0\0\0"
        want[k] = (len(ids) // 4, zlib.crc32(ids[: 4 * (len(ids) // 4 % 1024 or 1024)] if len(ids) > 4096 else ids))
    out = cp.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (sum(x["length"] for x in out if x["doc_id"] == r["doc_id"]), r["ids_crc32"]) for r in out if r["piece"] == 0} == want and len(want) == len(now)
    seqs = Counter()
    for r in out:
        seqs[r["sequence_id"]] += r["length"]
    assert max(seqs.values()) <= 1024
    for name, step in cp.STAGES:
        got = step(spark, read.limit(0), str(tmp_path))
        assert got.count() == 0 and (name == "pack" or got.columns == read.columns)
