"""Every operator against a plain version of the same task, and on odd rows and empty tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from epipanel.llm import (
    chunked_bpe,
    components,
    jaccard_join,
    language,
    packing,
    personal_data,
    perspectives,
    phrases,
    quality_rules,
    queries,
    repeats,
    stages,
    toxicity,
    wordcodec,
)

from .conftest import words

PATH = public_tokenizers.path("word_bpe_49k.json")
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def texts(sf):
    import duckdb

    return duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by doc_id").fetchall()


# quality rules


def plain_counts(text):
    found = re.findall(WORD, text)
    often = Counter(zip(found, found[1:], found[2:], strict=False))
    covered = {k + j for k in range(len(found) - 2) if often[tuple(found[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_op1_counts_and_verdict(spark, sf):
    rows = queries.op1_decision_list(spark, sf).toPandas().set_index("doc_id")
    for doc, text in texts(sf):
        n, chars, signs, dup, again = plain_counts(text)
        r = rows.loc[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, signs, dup, again)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert r.kept == (not r.base_failed and r["rule"] == 0)


def test_rules_are_learned_in_order_and_run_as_columns(spark):
    rng = np.random.default_rng(0)
    table = {name: rng.random(600) for name in quality_rules.FEATURES}
    bad = (table["upper_share"] > 0.7) | (table["dup_line_share"] > 0.8) & (table["word_length"] <= 0.5)
    rules = quality_rules.learn_list(table, bad)
    hit = np.zeros(600, bool)
    for rule in rules:
        hit |= quality_rules.covers(rule, table)
    assert len(rules) >= 2 and (hit == bad).mean() > 0.97
    frame = spark.createDataFrame([tuple(float(table[f][k]) for f in quality_rules.FEATURES) for k in range(600)], list(quality_rules.FEATURES))
    assert [r[0] > 0 for r in frame.select(quality_rules.rule_column(rules)).collect()] == hit.tolist()


def test_rules_on_odd_rows(odd, none, labels):
    rows = quality_rules.judge(odd, labels).toPandas()
    assert len(rows) == odd.count() and not rows[rows.doc_id.isin([0, 1, 2, 3])].kept.any()
    assert quality_rules.judge(none, labels).count() == 0
    assert quality_rules.judge(odd, labels.where("false")).where("not base_failed and not kept").count() == 0


# toxicity


@pytest.fixture(scope="module")
def grams():
    text = "the idiot and the clown were pathetic losers said the stupid moron of this trash " * 40 + "reading other ordinary words here " * 40
    c = toxicity.signs(text).astype(int)
    key = ((c[:-3] * 28 + c[1:-2]) * 28 + c[2:-1]) * 28 + c[3:]
    return toxicity.log_model(np.bincount(key, minlength=28**4))


def test_obfuscated_words_are_restored(grams):
    model = toxicity.Model(grams, -3.0)
    for written, meant in (("1d10t", "idiot"), ("i d i o t", "idiot"), ("st*pid", "stupid"), ("cl0wn", "clown"), ("moooron", "moron"), ("tra$h", "trash"), ("i.d.i.o.t", "idiot")):
        assert meant in model.clean(f"the {written} and").split(), written
    assert model.clean("plain words, nothing else") == "plain words, nothing else"


def test_signs_at_the_end_and_among_set_apart_letters(grams):
    model = toxicity.Model(grams, -3.0)
    for written, meant in (("idio7", "idiot"), ("idio+", "idiot"), ("idio7,", "idiot"), ("moro#", "moron"), ("clow*.", "clown"), ("i d 1 0 t", "idiot"), ("m 0 r o n", "moron")):
        assert meant in toxicity.WORDS.findall(model.clean(f"the {written} and")), written
    for plain in ("stupid!", "the idiot! and", "trash?", "1 2 3 4 5", "12 b 34"):
        assert model.clean(plain) == plain


def test_windows_find_all_that_the_pattern_finds(grams, sf):
    model = toxicity.Model(grams, -3.0)
    rng = np.random.default_rng(8)
    for _ in range(4000):
        text = "".join(rng.choice(list("aabcc1$*!.- \n,#7"), rng.integers(1, 16)))
        assert model.clean(text) == toxicity.SUSPECT.sub(model.restored, text), text
    for _, text in texts(sf):
        assert model.clean(text) == toxicity.SUSPECT.sub(model.restored, text)


def test_op2_held_out(spark, sf):
    import duckdb

    rows = queries.op2_deobfuscated_toxicity(spark, sf).toPandas()
    assert len(rows) == len(texts(sf)) and rows.score.between(0, 1).all()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    assert (rows.predicted == (rows.score >= 0.5)).all()
    big = queries.op2_deobfuscated_toxicity(spark, "/root/testdata/sf0.01").toPandas()
    known = duckdb.sql("select doc_id, max(toxic) as toxic from '/root/testdata/sf0.01/labels.parquet' group by 1").df().merge(big[big.held_out])
    rank, one = known.score.rank(), known.toxic == 1
    auc = (rank[one].sum() - one.sum() * (one.sum() + 1) / 2) / (one.sum() * (~one).sum())
    assert auc > 0.85


def test_toxicity_on_odd_rows(odd, none, labels):
    assert toxicity.rate(odd, labels).count() == odd.count()
    assert toxicity.rate(none, labels).count() == 0
    unknown = toxicity.rate(odd, labels.where("false")).toPandas()
    assert (unknown.predicted == 0).all()
    kept = toxicity.keep_clean(odd, toxicity.fit(odd, labels.where("false")))
    assert kept.columns == odd.columns and kept.count() == odd.count()


# BPE


def plain_coding(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


ODD_TEXTS = [
    "", " ", "don't I'LL 'S x's", "á é", " ́x", "ΑΣ ΣΑΣ", "<|endoftext|> a<|endoftext|>b", "ﬁ Ⅷ ² ¼½", "ÀÉÎ straße ÿ", "a_b-c!!!? 'twas 're",
    "日本語 テスト", "İstanbul", "a\x1cb\x85c", "😀 ok <|startoftext|>", "a'sb ''s 's's", "x" * 9000, "<|endoftext|>" * 900, "é" * 5000, words(3000),
]


def test_codec_equals_the_library(tokenizer):
    coder = wordcodec.WordCodec(PATH)
    for text in ODD_TEXTS:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:40]


def test_op3_equals_the_library(spark, sf, tokenizer):
    rows = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op3_chunk_reuse_bpe(spark, sf).collect()}
    assert rows == {doc: plain_coding(tokenizer, text) for doc, text in texts(sf)}


def test_chunks_join_exactly(make, odd, none, tokenizer):
    docs = make(list(enumerate([*ODD_TEXTS, words(900, 8), words(50, 9) + " " + words(900, 8)])))
    for row in chunked_bpe.encode_decode(docs, PATH).join(docs.select(F.col("doc_id"), F.col("text").alias("whole")), "doc_id").collect():
        assert np.frombuffer(row.ids, "<u4").tolist() == tokenizer.encode(row.whole, add_special_tokens=False).ids
    assert chunked_bpe.encode_decode(odd, PATH).count() == odd.count()
    assert chunked_bpe.encode_decode(none, PATH).count() == 0


def test_chunks_follow_content():
    shared = words(2000, 3)
    a, b = set(chunked_bpe.chunks(words(40, 1) + shared)), set(chunked_bpe.chunks(words(333, 2) + shared))
    assert len(a & b) >= len(a) - 4 and "".join(chunked_bpe.chunks(shared)) == shared


# perspectives


def test_rotation_of_odd_conversations(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, None, "x"), (1, None, "ann", "é"), (None, 0, "ann", "n"), (2, 0, "system", "only"), (1, 5000, "ann", "late")],
        "conv_id long, turn long, role string, text string",
    ).withColumn("viewer", F.lit(1)).withColumn("segment", F.lit("q"))
    rows = perspectives.rotate(turns).toPandas()
    assert set(rows.viewer[rows.conv_id == 1]) == {"ann", "bob", "unknown"} and not (rows.conv_id == 2).any()
    for _, view in rows.groupby(["conv_id", "viewer"], dropna=False):
        view = view.sort_values("seg_start")
        whole = "".join(view.segment)
        assert (view.seg_start == view.segment.str.len().cumsum() - view.segment.str.len()).all()
        for r in view.itertuples():
            assert whole[r.seg_start : r.seg_start + len(r.segment)] == r.segment
            assert whole[r.body_end :].startswith("<|im_end|>\n") and r.trained == (r.speaker == r.viewer)
    assert perspectives.rotate(turns.where("false")).count() == 0


# personal data


def plain_spans(text):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(d[::2]) % 10 == -sum(sum(divmod(2 * x, 10)) for x in d[1::2]) % 10:
            out.append((m.start(), 2, "card", m.end()))
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_op5_base_spans(spark, sf):
    rows = {r.doc_id: r for r in queries.op5_boosted_pii(spark, "/root/testdata/sf0.01").collect()}
    for doc, text in texts("/root/testdata/sf0.01"):
        base = plain_spans(text)
        assert rows[doc].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(rows[doc].spans.split(","))


def test_base_spans_on_noise():
    rng = np.random.default_rng(3)
    for _ in range(4000):
        text = "".join(rng.choice(list("a.@1-+ (0)%2 "), rng.integers(1, 60)))
        assert personal_data.listed(personal_data.base_spans(text)) == plain_spans(text)


def test_added_spans_and_odd_rows(make, odd, none):
    model = personal_data.fit(none)
    for text, kind in (("call me (415) 555-2671 now", "phone"), ("mail jane.roe (at) host.org today", "email"), ("card 4111.1111.1111.1111 ok", "card"), ("host 10[.]20[.]30[.]40 up", "ip")):
        assert [s[0] for s in personal_data.added_spans(text, personal_data.base_spans(text), model)] == [kind], text
    for text in ("on 2024-01-02 at 10.20.30", "met at noon. dot", "1234567", "4111 1111 1111 1112", "version 1.2.3"):
        assert not personal_data.added_spans(text, personal_data.base_spans(text), model), text
    docs = make([(1, "a@b.co and +1 (415) 555-2671"), (2, None), (3, "")])
    assert {r.doc_id: (r.text, r.n_chars) for r in personal_data.redact(docs, model).collect()} == {1: ("[EMAIL] and [PHONE]", 19), 2: (None, None), 3: ("", 0)}
    assert personal_data.find(odd, model).count() == odd.count() and personal_data.find(none, model).count() == 0


def test_parts_of_chains_and_all_signs_of_mails_are_proposed(none):
    model = personal_data.fit(none)
    for text, kind, own in (
        ("card 4111 1111 1111 1111 12/27 ok", "card", "4111 1111 1111 1111"), ("card 4111-1111-1111-1111 123 ok", "card", "4111-1111-1111-1111"),
        ("pay 4111111111111111 12/27", "card", "4111111111111111"), ("call 415-555-2671 9-5 daily", "phone", "415-555-2671"),
        ("mail jane at host.org or", "email", ""), ("mail jane{AT}host.org", "email", "jane{AT}host.org"), ("mail jane AT host DOT org today", "email", "jane AT host DOT org"),
    ):
        base = personal_data.base_spans(text)
        if own:
            assert [(k, text[a:b]) for k, a, b in personal_data.added_spans(text, base, model)] == [(kind, own)], text
        else:
            assert any(s[0] == kind for s in personal_data.candidates(text, base)), text
    for text in ("she arrived at home. Then", "1 2 3 4 5 6 7 8 9 10 11 12 13", "12 345 678 910 111 213 141 516"):
        assert not personal_data.added_spans(text, personal_data.base_spans(text), model), text
    assert len(personal_data.candidates("1 " * 20_000, [])) < 20 * 20_000


def test_the_core_of_mails_is_in_every_mail():
    rng = np.random.default_rng(6)
    pieces = ["@", "(at)", "[AT]", "{At}", " at ", " AT ", ".", "(dot)", "[DOT]", "{dot}", " dot ", " Dot ", "ab", "c-d", "9", " ", "é"]
    found = 0
    for _ in range(20_000):
        text = "".join(rng.choice(pieces, rng.integers(3, 9)))
        if personal_data.MAIL.search(text):
            found += 1
            assert personal_data.MAIL_CORE.search(text), text
    assert found > 400


# fingerprints


def test_op6_pairs_and_likeness(spark, sf):
    rows = {r.doc_id: r for r in queries.op6_parsing_fingerprint(spark, sf).collect()}
    order = texts(sf)[::-1]
    for k, (doc, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert rows[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[doc].n_chars == len(text)
    near = np.array([(r.near_edited, r.near_next) for r in rows.values()])
    assert len(rows) == len(order) and ((near >= 0) & (near <= 1)).all() and (near[:, 0] > near[:, 1]).mean() > 0.95


def test_parsing_is_locally_consistent():
    shared = words(400, 6)
    alone = phrases.sketches([shared])[0]
    for lead in ("", "x ", words(30, 7) + " "):
        assert phrases.likeness(phrases.sketches([lead + shared])[0], alone) > 0.7
    assert phrases.likeness(phrases.sketches([words(400, 8)])[0], alone) < 0.1
    batch = ["b", shared, "", "aaaa" * 50, shared]
    assert [phrases.written(s) for s in phrases.sketches(batch)] == [phrases.written(phrases.sketches([t])[0]) for t in batch]


def test_fingerprints_of_odd_rows(odd, none):
    rows = phrases.with_next(odd).toPandas()
    assert len(rows) == odd.count() and rows.near_edited.between(0, 1).all()
    assert phrases.with_next(none).count() == 0
    assert phrases.with_next(odd.where("doc_id = 6")).collect()[0].near_next == 1.0


# packing


def test_op7_places(spark, sf, tokenizer):
    rows = queries.op7_complement_packing(spark, sf).toPandas()
    for doc, text in texts(sf):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        own = rows[rows.doc_id == doc].sort_values("piece")
        assert own.length.sum() == len(ids) and (own.length[:-1] == 4096).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    check_places(rows, 4096)


def check_places(rows, capacity):
    rows = rows.sort_values(["sequence_id", "offset"])
    total = rows.groupby("sequence_id").length.sum()
    assert (rows.groupby("sequence_id").length.cumsum() - rows.length == rows.offset).all() and total.max() <= capacity
    return len(total)


def test_plan_fills_gaps_exactly():
    rng = np.random.default_rng(1)
    for capacity, n in ((16, 200), (97, 500), (512, 3000)):
        lengths = rng.integers(1, capacity + 1, n)
        counts = np.bincount(lengths, minlength=capacity + 1)
        steps = packing.plan(counts, capacity)
        used = Counter()
        for step in steps:
            assert sum(a * b for a, b in step.items) <= capacity
            for length, many in step.items:
                used[length] += many * step.bins
        assert used == Counter(lengths.tolist())
        best_fit = []
        for length in sorted(lengths.tolist(), reverse=True):
            fits = [k for k, g in enumerate(best_fit) if g >= length]
            if fits:
                k = min(fits, key=best_fit.__getitem__)
                best_fit[k] -= length
            else:
                best_fit.append(capacity - length)
        assert sum(s.bins for s in steps) <= len(best_fit)


def test_packing_of_odd_rows(odd, none):
    rows = packing.pack_documents(odd, PATH, capacity=64).toPandas()
    assert len(rows[rows.piece == 0]) == odd.count()
    check_places(rows, 64)
    assert packing.pack_documents(none, PATH).count() == 0


# near duplicates


def plain_classes(rows):
    sets = {}
    for doc, text in rows:
        w = re.findall(WORD, text or "")
        sets[doc] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root, links = {d: d for d in sets}, Counter()

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    by_shingle = defaultdict(set)
    for d, s in sets.items():
        for g in s:
            by_shingle[g].add(d)
    pairs = {(a, b) for ds in by_shingle.values() for a in ds for b in ds if a < b}
    for a, b in pairs:
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (find(d), links[d]) for d in sets}


def test_op8_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op8_bayes_jaccard(spark, sf).collect()}
    assert got == plain_classes(texts(sf))


def near_copies(n, seed):
    base = words(300, seed).split()
    out = []
    for k in range(n):
        own = list(base)
        for j in range(k % 9):
            own[(37 * k + 53 * j) % 300] = f"new{k}x{j}"
        out.append(" ".join(own))
    return out


def test_large_groups_are_compared_in_blocks(make, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    rows = list(enumerate([*near_copies(60, 1), *near_copies(5, 2), words(200, 3), "one two", "one two", None, "", " "]))
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.classes(make(rows)).collect()}
    assert got == plain_classes(rows)


def test_near_duplicates_of_odd_rows(odd, none):
    rows = jaccard_join.classes(odd).toPandas()
    assert len(rows) == odd.count() and jaccard_join.classes(none).count() == 0
    assert (rows[rows.doc_id.isin([4, 5])].n_links == 2).all()
    kept = jaccard_join.keep_representatives(odd)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 2**62] and ids.count(None) == 2


def test_classes_that_share_a_doc_id_or_have_none_keep_their_texts(make):
    near = near_copies(3, 21)
    texts_ = [words(90, k) for k in range(30, 34)]
    rows = [(1, texts_[0]), (1, texts_[1]), (None, texts_[2]), (None, texts_[3]), (None, near[0]), (None, near[1]), (None, near[1]), (7, near[2]), (None, " ")]
    kept = Counter((r.doc_id, r.text) for r in jaccard_join.keep_representatives(make(rows)).collect())
    assert kept == Counter([(1, texts_[0]), (1, texts_[1]), (None, texts_[2]), (None, texts_[3]), (7, near[2]), (None, " ")])
    found = jaccard_join.classes(make(rows)).where("set_id is not null").toPandas()
    assert found.class_root.nunique() == 5 and sorted(found.n_links) == [0, 0, 0, 0, 3, 3, 3, 3]


def test_rows_meet_only_their_own_set(make, monkeypatch):
    sizes = []
    verified = jaccard_join.verified

    def watched(docs, groups, threshold):
        frame = type(docs)
        join = frame.join

        def counted(self, other, on=None, how=None):
            out = join(self, other, on, how) if how else join(self, other, on)
            sizes.append(out.count())
            return out

        with monkeypatch.context() as m:
            m.setattr(frame, "join", counted)
            return verified(docs, groups, threshold)

    monkeypatch.setattr(jaccard_join, "verified", watched)
    rows = [(None, t) for k in range(12) for t in near_copies(2, 50 + k)]
    jaccard_join.classes(make(rows))
    assert sizes == [24]


def test_posterior_bound():
    for n, least in jaccard_join.least_matches():
        assert 0 <= least < 0.8 * n
    assert dict(jaccard_join.least_matches())[128] > 70


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(k, k + 1) for k in range(1000, 1060)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


# language


def test_gradients():
    net = language.Network.blank(["a", "b", "c"], np.random.default_rng(0))
    net.weights = {k: v.astype(float) for k, v in net.weights.items()}
    batch, target = [b"abc", b"hello", b"zz"], np.array([0, 1, 2])
    grads, _ = net.slopes(batch, target)
    for name, weight in net.weights.items():
        at = np.unravel_index(np.argmax(np.abs(grads[name])), weight.shape)
        weight[at] += 1e-3
        up = net.slopes(batch, target)[1]
        weight[at] -= 2e-3
        down = net.slopes(batch, target)[1]
        weight[at] += 1e-3
        assert abs((up - down) / 2e-3 - grads[name][at]) < 1e-4


def test_op9_held_out(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    rows = queries.op9_bigru_language(spark, sf).toPandas().merge(duckdb.sql(f"select doc_id, lang from '{sf}/documents.parquet'").df())
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]).all() and rows.score.between(0, 1).all()
    assert (rows.lang == rows.lang_pred)[rows.held_out].mean() > 0.97


def test_language_of_odd_rows(odd, none):
    rows = language.identify(odd).toPandas()
    assert len(rows) == odd.count()
    assert set(rows.lang_pred[rows.doc_id.isin([0, 1, 2])]) == {"und"} and set(rows.lang_pred[rows.doc_id.isin([3, 6])]) == {"en"}
    assert language.identify(none).count() == 0
    assert set(language.predict(odd, language.Network([])).toPandas().lang_pred) == {"und"}


# repeats


def plain_removal(rows, length=200):
    raw = [(d, (t or "").encode()) for d, t in rows]
    often = Counter(b[s : s + length] for _, b in raw for s in range(len(b) - length + 1))
    out = Counter()
    for d, b in raw:
        hit = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if often[b[s : s + length]] > 1:
                hit[s : s + length] = True
        runs = int((np.diff(np.r_[0, hit.astype(int)]) == 1).sum())
        out[d, len(b), int(hit.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~hit].tobytes()).hexdigest()] += 1
    return out


def removed(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())


def test_op10_equals_all_strings(spark, sf):
    got = Counter(tuple(r) for r in queries.op10_interval_tree_dedup(spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == plain_removal(texts(sf))


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeats_at_every_offset(make, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    passage = words(120, 1)
    rows = [(k, words(20 + k, 10 + k) + passage[k * 3 : 330 + 7 * k] + words(15, 40 + k)) for k in range(12)]
    rows += [(20, passage[:200]), (21, passage[:199]), (22, passage[5:204] + "é" * 150), (23, words(9, 77) + "é" * 130), (24, "ab" * 400), (25, "c" * 500), (26, None), (27, "")]
    rows += [(28, words(50, 5)), (28, words(50, 5)), (None, words(60, 6)), (29, words(60, 6)[7:])]
    assert removed(repeats.deduplicated(make(rows))) == plain_removal(rows)


def test_groups_of_a_hot_anchor_are_bounded(make, monkeypatch):
    held = []
    resolved = repeats.resolved

    def watched(needs):
        sizes = needs.groupBy("group").agg(F.sum(F.length("bytes")).alias("n")).agg(F.max("n")).first()[0]
        held.append(sizes or 0)
        return resolved(needs)

    monkeypatch.setattr(repeats, "HOT", 3)
    monkeypatch.setattr(repeats, "resolved", watched)
    footer = words(40, 3)[:150]
    rows = [(k, words(60, 100 + k) + footer + words(60, 200 + k)) for k in range(40)]
    rows += [(50, rows[0][1][250:]), (51, "x" + rows[1][1][200:]), (None, rows[2][1][-420:])]
    assert removed(repeats.deduplicated(make(rows))) == plain_removal(rows)
    assert max(held) <= 3 * (2 * repeats.LENGTH - repeats.WIDTH)


def test_maximal_repeats_have_all_occurrences():
    a, b, c = words(60, 1).encode(), words(60, 2).encode(), words(60, 3).encode()
    found = {(n, tuple(sorted(p.tolist()))) for n, p in repeats.maximal_repeats([a + b, b + c, c + b[:210]], 200)}
    first = (len(a), len(a) + len(b) + 1, len(a) + 2 * len(b) + 2 + 2 * len(c))
    assert (210, first) in found and (len(b), first[:2]) in found


def test_repeats_of_odd_rows(odd, none):
    assert repeats.deduplicated(odd).count() == odd.count() and repeats.deduplicated(none).count() == 0
    kept = repeats.without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert {r.text for r in kept.where("doc_id in (4, 5, 7)").collect()} == {""}


# pipeline


def test_stages_take_effect(spark, make, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = stages.keep_one_of_each_group(spark, docs, sf)
    expected = plain_classes(texts(sf))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (c, _) in expected.items() if c == d)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "personal_data", "packing"]
    rows = corpus_pipeline.run(spark, sf).toPandas()
    check_places(rows, 4096)
    assert set(rows.doc_id) <= {d for d, _ in texts(sf)}


@pytest.mark.parametrize("kind", ["odd", "none"])
def test_pipeline_on_odd_tables(spark, tmp_path, labels, request, kind):
    import corpus_pipeline

    docs = request.getfixturevalue(kind).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.where("toxic = 0").write.parquet(f"{tmp_path}/labels.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert rows.empty == (kind == "none")
    if kind == "odd":
        check_places(rows, 4096)
        assert {0, 1, 2, 3, 4, 6, 7, 8, 9, 10} == set(rows.doc_id.dropna().astype(int)) - {2**62} and 5 not in set(rows.doc_id)
