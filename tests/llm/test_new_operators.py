"""Concatenating, conversation tries and divergence against brute force, with nulls, empty and long values, ties, repeats and odd columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import concat, divergence, tries
from tallyframe.llm.byte_tokens import ByteEncoder
from tallyframe.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTES = "byte_bpe_50k.json"


# --- concatenate and cut --------------------------------------------------------


def test_byte_encoder_equals_the_tokenizer():
    encoder = ByteEncoder(tokenizer_file(BYTES), most_words=20)
    texts = ["it's I'll  x\n\n y 's''s", "<|endoftext|> hi", "a\x1cb\xa0c²3", "", "  ", "don't!!??\r\n\t z", "ÀÖ×÷ ½¾ x12", "漢字 é “q”", "x" * 3000 + "  \n "]
    rng = random.Random(1)
    texts += ["".join(rng.choice("ab Z'\n\t.,!19éß«×'sl ") for _ in range(200)) for _ in range(100)]
    want = [encoder.whole(t) for t in texts]
    assert [encoder.ids(t) for t in texts * 2] == want * 2


@pytest.mark.parametrize("size", [64, 1024])
def test_concat_round_trip(spark, size):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(90))) for _ in range(60)] + [None, "", "", "x" * 20_000, "long word " * 3000]
    rows = [(i, t, "k", 0) for i, t in enumerate(texts)] + [(3, texts[3], "k", 0), (None, "no id", "k", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, part string, ids long").repartition(5)
    packed = concat.pack(frame, tokenizer_file(BYTES), size=size, with_ids=True)
    pieces, encoder = packed.collect(), ByteEncoder(tokenizer_file(BYTES))
    end = (0).to_bytes(4, "little")
    want = Counter((doc, encoder.whole(t or "") + end) for doc, t, *_ in rows)
    got, held = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"] > 0
        held[p["sequence_id"]].append((p["offset"], p["length"], bytes(p["ids"])))
        got[p["doc_id"]].append((p["start"], bytes(p["ids"]), p["doc_tokens"]))
    for doc in {d for d, _ in want}:
        copies = sum(n for (d, _), n in want.items() if d == doc)
        whole = {ids: len(ids) // 4 for d, ids in want if d == doc}
        assert sum(len(ids) for _, ids, _ in got[doc]) == copies * len(next(iter(whole))) and {n for *_, n in got[doc]} == set(whole.values())
        if copies == 1:
            assert b"".join(ids for _, ids, _ in sorted(got[doc])) == next(iter(whole))
    total, lengths = sum(p["length"] for p in pieces), []
    for parts in held.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        lengths.append(at)
    # Nothing is padded: whole windows, then powers of two.
    assert sum(n == size for n in lengths) >= total // size and all(n == size or n.bit_count() == 1 for n in lengths) and len(lengths) <= total // size + 11
    joined = {r["sequence_id"]: r for r in concat.sequences(packed, size=size).collect()}
    assert {s: bytes(r["ids"]) for s, r in joined.items()} == {s: b"".join(x for *_, x in sorted(p)) for s, p in held.items()}
    assert {r["padding"] for r in joined.values()} == {0}


def test_concat_of_nothing(spark):
    none = concat.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_file(BYTES), with_ids=True)
    assert none.count() == 0 and concat.sequences(none).count() == 0
    assert concat.last_windows(2048 + 700, 1024) == [(2048, 512), (2560, 128), (2688, 32), (2720, 16), (2736, 8), (2744, 4)]


# --- conversation trie ------------------------------------------------------------


def brute_trie(rebuilt):
    members, children, ended = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
        ended[turns].append(c)
    leaves, saving = Counter(), Counter()
    for node, of in members.items():
        cost = (len(of) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saving[node[:d]] += cost
    return {
        (min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]) if node in children else 0, leaves[node], saving[node],
         hashlib.sha256(",".join(map(str, sorted(ended.get(node, [])))).encode()).hexdigest())
        for node, of in members.items()
    }


def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t for *_, t in sorted(r, key=lambda x: x[:2])] for c, r in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    return out


@pytest.mark.parametrize("cells", [20, 300, 1_000_000])
def test_trie_against_brute_force(spark, cells):
    rng, rows = random.Random(cells), []
    said = ["hello you", "a b c", "", None, "one", "x " * 50]
    for c in range(260):
        turns = [("user", said[0])] if c % 3 else []
        turns += [(rng.choice(["user", "assistant", None]), rng.choice(said)) for _ in range(rng.randrange(5))]
        if c % 7 == 0:  # a third and more of them are one conversation
            turns = [("user", "same"), ("assistant", "same too")]
        if c % 41 == 5:
            turns = [("user", f"t{k % 5}") for k in range(70 + c % 3)]
        rows += [(c * 3, k if k or c % 2 else None, *t) for k, t in enumerate(turns)]
    rows.append((None, 0, "user", "of nobody"))
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, keys string, shard int").repartition(4)
    got = tries.trie(tries.with_shared_heads(tries.turn_paths(frame)), cells_a_shard=cells)
    assert got.columns == tries.RESULT
    rebuilt = brute_rebuilt(rows)
    found = [tuple(r) for r in got.collect()]
    want = brute_trie(rebuilt)
    assert len(found) == len(set(found)) and set(found) == want
    assert () in rebuilt.values()


def test_trie_repeated_rows_ties_and_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (7, 0, "user", "b"), (7, 0, "user", "a"), (7, 0, "user", "a")], schema)
    got = {(r["depth"], r["n_convs"]) for r in tries.trie(tries.turn_paths(frame)).collect()}
    assert got == {(0, 2), (1, 2), (2, 2), (3, 2)}
    assert tries.trie(tries.with_shared_heads(tries.turn_paths(frame.limit(0)))).count() == 0


def test_path_order_and_shared_lengths():
    rng = np.random.default_rng(5)
    paths = [tuple(rng.integers(1, 3, rng.integers(0, 90)).tolist()) for _ in range(200)]
    paths = [p if k % 2 else (1,) * 64 + p for k, p in enumerate(paths)] + [paths[0], paths[0], ()]
    lens = np.array([len(p) for p in paths])
    starts, ids, conv = np.cumsum(lens) - lens, np.array([x for p in paths for x in p]), rng.permutation(len(paths))
    order = tries.path_order(ids, starts, lens, conv)
    assert order.tolist() == sorted(range(len(paths)), key=lambda i: (paths[i], conv[i]))
    got = tries.shared_length(ids, (starts[order[:-1]], lens[order[:-1]]), (starts[order[1:]], lens[order[1:]]))
    for x, y, n in zip(order, order[1:], got):
        same = [a == b for a, b in zip(paths[x], paths[y])]
        assert n == (same.index(False) if False in same else len(same))


# --- divergence -------------------------------------------------------------------


def brute_divergence(rows, top=200):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, out = defaultdict(Counter), defaultdict(Counter), []
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        groups = {s: Counter({t: c[t] for t in kept}) for (g, s), c in counts.items() if g == lang}
        whole = sum(groups.values(), Counter())
        p_of = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        q, ps = p_of(whole), {s: p_of(c) for s, c in groups.items()}
        for s in groups:
            f = lambda p, q: (p - q) ** 2 // q
            pairs = sorted(((-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode(), o) for o in groups if o != s))
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)]
            terms = sorted((-f(ps[s][t], q[t]), t.encode(), t) for t in kept if groups[s][t] and ps[s][t] > q[t])
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(terms[:top])]
    return Counter(out)


@pytest.mark.parametrize("top", [5, 200])
def test_divergence_against_brute_force(spark, top):
    rng, rows = random.Random(top), []
    vocabulary = [f"{a}{b}" for a in "abcdé漢\U0001f600ÄZ" for b in "xyzüQ"] + ["word" + c * k for c in "pq" for k in range(30)]
    for i in range(300):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s1", "s2", "S3", "é", None])
        text = rng.choice([" ", "\n", "9", "\x00"]).join(rng.choice(vocabulary[: 20 if source == "s1" else None]) for _ in range(rng.randrange(60)))
        rows.append((text, lang, source))
    rows += [rows[0], rows[0], (None, "en", "empty"), ("123", "fr", "a"), ("once", "fr", "b"), ("y" * 40_000 + " yes", "de", "s2"), ("only alone", "it", "x")]
    rows += [("same text here", "nl", "one")] * 3
    frame = spark.createDataFrame([(i, *r, 1, "k") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n int, term string").repartition(4)
    got = divergence.audit(frame, top=top).collect()
    assert Counter((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got) == brute_divergence(rows, top)
    assert divergence.audit(frame.limit(0)).count() == 0


def test_shares_of_very_large_counts(spark):
    n, total = 600_000_000_000, 9_000_000_000_000
    got = spark.range(1).select(divergence.share(F.lit(n).cast("long"), F.lit(total).cast("long"), F.lit(5).cast("long"))).first()[0]
    assert got == 1 + 10**9 * (n + 1) // (total + 5)
