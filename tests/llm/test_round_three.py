"""Decontamination, conversation repair and collocations against plain versions, and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from epipanel.llm import collocations, queries, turn_repair, winnowing

from .conftest import words

# decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_hits(docs, items):
    """doc_id, n_words, hit places, items for each document."""
    cut = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = cut(text)
        n = min(len(w), winnowing.SPAN)
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, places, found = cut(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    places |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((doc, len(w), len(places), sorted(found)))
    return sorted(out, key=repr)


def held_against_plain(spark, docs, items):
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, key int, window string")
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, start int")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in winnowing.decontaminate(frame, bench).collect()]
    assert sorted(got, key=repr) == plain_hits(docs, items)
    return got


def test_spans_are_found_wherever_they_stand(spark):
    long, other = words(60, 1).split(), words(60, 2).split()
    docs = [(k, " ".join(other[:k] + long[k : k + 10] + other[k : k + 20])) for k in range(20)]
    docs += [(90 + k, " ".join(long[k : k + 9])) for k in range(3)]
    got = held_against_plain(spark, docs, [(1, " ".join(long)), (2, " ".join(long[5:30]).upper())])
    assert sum(r[2] > 0 for r in got) == 20


def test_decontamination_on_odd_rows(spark):
    text = words(40, 3)
    docs = [
        (1, None), (2, ""), (3, " .,;"), (4, text), (4, text), (None, text), (5, "A" * 3000), (6, "one two three"), (7, "One, two!"),
        (8, "a a a a a a a a a a a a a a a a a a a a"), (9, "Éa éa two one two, one two"), (10, words(3000, 9) + " " + text + " " + words(500, 8)),
    ]
    items = [(1, None), (2, ""), (3, text), (3, text), (30, text), (None, text), (4, "two"), (5, "one TWO"), (6, "a " * 14), (7, "b a a a"), (8, words(10, 4))]
    held_against_plain(spark, docs, items)
    held_against_plain(spark, docs, [])
    held_against_plain(spark, [], items)
    held_against_plain(spark, docs, [(1, text)])


# conversations

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired): whole edit strings compared, for each state (9: a system turn stands) and row from the last."""
    found = faults(rows)
    to = {0: ("user", 1), 9: ("user", 1), 2: ("user", 1), 1: ("assistant", 2)}
    first = lambda x: x[:2]

    def with_inserts(best):
        for _ in range(4):
            for state, (role, then) in to.items():
                if then in best:
                    cost, audit, kept = best[then]
                    best[state] = min([(cost + 3, "I" + audit, [f"{role}:", *kept]), *([best[state]] if state in best else [])], key=first)
        return best

    best = with_inserts({0: (0, "", []), 2: (0, "", [])})
    for (role, text), fault in zip(reversed(rows), reversed(found)):
        new = {}
        for state, (written, then) in to.items():
            cost, audit, kept = best[state]
            options = [(cost + 4, "D" + audit, kept)]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                cost, audit, kept = best[then]
                options.append((cost + 3 + extra, "R" + audit, [f"{written}:{text}", *kept]))
                stands = {"s": 9 if state == 0 else None, "u": 1 if then == 1 else None, "a": 2 if then == 2 else None}.get(role[:1])
                if stands is not None:
                    cost, audit, kept = best[stands]
                    options.append((cost + extra, "K" + audit, [f"{role}:{text}", *kept]))
            new[state] = min(options, key=first)
        best = with_inserts(new)
    return best[0]


def plain_repair(rows):
    """Digest of one conversation's (turn, role, text) rows in order."""
    pairs = [(r, t) for _, r, t in rows]
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    count = Counter(faults(pairs))
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:]))
    cost, audit, kept = cheapest(pairs)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_op12_against_every_edit(spark, sf):
    import duckdb

    given = defaultdict(list)
    for conv, turn, role, text in duckdb.sql(f"select conv_id, turn, role, text from '{sf}/conversations.parquet'").fetchall():
        role, text = " " if role is None else role, " " if text is None else text
        kept = given[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in queries.op12_checkpointed_repair(spark, sf).collect()}
    assert got == {conv: plain_repair(in_order(rows)) for conv, rows in given.items()}


def test_repair_of_random_conversations(spark, monkeypatch):
    rng = np.random.default_rng(5)
    roles, texts = ["system", "user", "assistant", "tool", "", "u2"], ["a.", "b!", "c", "d?", "", " \t", "e"]
    rows = []
    for conv in range(300):
        for turn in range(int(rng.integers(1, 12))):
            rows.append((conv, None if rng.random() < 0.05 else turn // 2 * 2, roles[rng.integers(0, 6)], texts[rng.integers(0, 7)] + str(rng.integers(0, 3))))
    rows += [(None, 1, "user", "hi."), (None, 2, "user", "hi."), (None, None, None, None), (500, None, "user", "x."), (501, 3, "user", None)]
    rows += [(502, k % 400, "user" if k % 3 else "assistant", f"t{k % 350}" + ".x"[k % 2]) for k in range(900)]
    frame = spark.createDataFrame([(*r, 1, "z", 0) for r in rows], "conv_id long, turn long, role string, text string, step int, edit string, cost long")
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        given[conv].append((turn, " " if role is None else role, " " if text is None else text))
    monkeypatch.setattr(turn_repair, "FIRST_GAP", 3)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in turn_repair.digests(turn_repair.repair(frame)).collect()}
    want = {conv: plain_repair(in_order(r)) for conv, r in given.items()}
    assert got == want
    assert turn_repair.repair(frame.where("false")).count() == 0


def test_checkpoints_grow_as_the_square_root():
    rows = ({"conv_id": 1, "turn": -k, "role": "user", "digest": "", "initial": "u", "fault": ""} for k in range(20000))
    points = list(turn_repair.checkpoints_of(rows))
    assert 120 < len(points) < 200
    places = [-p[1] for p in points]
    assert max(np.diff(places)) <= turn_repair.FIRST_GAP + len(points)


# collocations


def plain_collocations(docs, least, top):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            sizes[lang] += len(w)
            for n in (1, 2, 3):
                counts[lang].update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        longer = [g for g, c in f.items() if len(g) == 3 and c >= least]
        rows = []
        for g, a in f.items():
            if len(g) < 2 or a < least or len(g) == 2 and any(100 * f[x] >= 50 * a for x in longer if g in (x[:2], x[1:])):
                continue
            cuts = [(10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def test_collocations_of_cut_texts(spark, make, monkeypatch):
    rng = np.random.default_rng(3)
    vocabulary = words(25, 6).split() + ["É", "日本語", "A", "b"]
    docs = []
    for k in range(40):
        line = [vocabulary[min(int(rng.exponential(6)), 28)] + ("" if rng.random() < 0.9 else ".,\n\t"[rng.integers(0, 4)]) for _ in range(150)]
        docs.append((k, "  ".join(line) if k % 7 == 0 else " ".join(line), ["en", "de", None][k % 3]))
    docs += [(50, None, "en"), (51, "", "xx"), (52, "\t \n", "yy"), (53, "one", "zz"), (54, "a" * 5000, "en"), (55, docs[0][1], "en"), (55, docs[0][1], "en")]
    want = plain_collocations([(d[2], d[1]) for d in docs], 4, 30)
    assert len(want) > 50
    got = lambda: sorted(tuple(r) for r in collocations.collocations(make(docs), 4, 30).collect())
    assert got() == want
    assert collocations.collocations(make(docs).where("false")).count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = np.random.default_rng(4)
    text = " ".join(words(12, 1).split()[rng.integers(0, 12)] + ("." if rng.random() < 0.02 else "") for _ in range(3000)) + " " + "x" * 400 + "  y  "
    everything = collocations.Bitmap(np.full(1 << 4, (1 << 64) - 1, np.uint64), 10)

    def total(n, segment, tokens):
        monkeypatch.setattr(collocations, "SEGMENT", segment)
        monkeypatch.setattr(collocations, "TOKENS", tokens)
        out, shard = Counter(), collocations.Shard(n)
        for _ in shard.add("en", text):
            for _, parts, counts in collocations.grams(shard, 0, everything):
                out.update(dict(zip(zip(*(p.tolist() for p in parts)), counts.tolist())))
            shard.clear()
        for _, parts, counts in collocations.grams(shard, 0, everything):
            out.update(dict(zip(zip(*(p.tolist() for p in parts)), counts.tolist())))
        return out

    for n in (2, 3):
        assert total(n, 1 << 20, 1 << 20) == total(n, 90, 1 << 20) == total(n, 333, 100)


@pytest.mark.parametrize("n", [2, 3])
def test_filters_are_lossless(n):
    rng = np.random.default_rng(n)
    ids = [rng.integers(0, 50, 4000).astype(np.uint64) for _ in range(n)]
    parts = collocations.permuted(ids)
    assert all((a == b).all() for a, b in zip(ids, collocations.restored(parts)))
    counts = rng.integers(1, 600, 4000)
    entries, sums = collocations.merged(parts, counts)
    want = Counter()
    for key, c in zip(zip(*(p.tolist() for p in parts)), counts.tolist()):
        want[key] += c
    assert dict(zip(zip(*(e.tolist() for e in entries)), sums.tolist())) == want
    bits = 4
    for q in (16, 24):
        for cut in range(1 << bits):
            mine = (entries[0] >> np.uint64(60)) == cut
            data = collocations.packed([e[mine] for e in entries], sums[mine], q, cut, bits)
            back, back_counts = collocations.unpacked(data, n, q, cut, bits)
            assert all((a == b[mine]).all() for a, b in zip(back, entries)) and (back_counts == sums[mine]).all()


def test_bitmap_never_denies_a_member(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63, 3000)
    held = collocations.bitmap(spark.createDataFrame([(int(v),) for v in values], "v long"), "v")
    assert held.holds(values.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 2**63, 20000).astype(np.uint64)
    assert held.holds(others).mean() < 0.12
