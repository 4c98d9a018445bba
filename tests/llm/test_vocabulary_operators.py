"""Token counts, token alignment and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import accumulate, combinations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from berthlake.llm import alignment, registry, spelling, token_counts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, key string, i bigint, word string, _row string"


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "own", 1, "own", "own") for i, t in zip(ids, texts)], SCHEMA)


def prose(r, n, letters="abcdefghinorstué"):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    base = [prose(r, r.randint(1, 120)) for _ in range(20)]
    odd = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n  b\n", "\n\n", "\t x", "▁", "a ▁b", "<s> </s> <unk> <|endoftext|> <0x41>",
           "naïve “quotes” — 12,345.67 it's we'll", "漢字かな交じり文。" * 30, "😀👩‍👩‍👧 é", "\x00\x01\x1c x \x85 y", "   z　w", "a" * 3000,
           "ab" * 1500, "=" * 999 + " " * 700 + "x", "x" + " " * 2500 + "y ", "١٢٣ абв", "0" * 2001, "word" * 900, "don't've 'S 's"]
    long = [prose(r, 3000), prose(r, 1500) + "\n" * 500 + prose(r, 800), "漢字かな交じり文。と" * 900,
            "".join(r.choice("abcXYZ019 \n.,;-é漢") for _ in range(9000))]
    return [*odd, *base, *base[:3], *long, long[0]]


def test_token_counts(spark, texts):
    model = SentencePieceProcessor(model_file=B)
    expected = [len(model.encode(t or "")) for t in texts]
    docs = table(spark, texts).repartition(3)
    # tiny overlaps fail at first and are widened
    for chunk, overlap in ((token_counts.CHUNK, token_counts.OVERLAP), (700, 60), (64, 2), (37, 1)):
        got = {r["_row"]["doc_id"]: r for r in token_counts.count(docs, B, chunk=chunk, overlap=overlap, limit=50).collect()}
        assert [got[i]["n_tokens"] for i in range(len(texts))] == expected, (chunk, overlap)
        assert all(r["over_limit"] == (r["n_tokens"] > 50) and r["_row"]["key"] == "own" for r in got.values())
    assert token_counts.count(table(spark, []), B).count() == 0


def test_token_counts_are_widened_where_chunks_have_no_common_token(spark):
    text = "ab" * 40
    rows = spark.createDataFrame([("k", text)], "key string, text string")
    model = SentencePieceProcessor(model_file=B)
    assert token_counts.spliced(rows, B, 11, 1).first()["n_tokens"] is None
    assert token_counts.long_counts(rows, B, 11, 1).collect() == [("k", len(model.encode(text)))]


def plain_alignment(texts):
    """The contract, token by token."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(k): k for k in own} | {chr(256 + n): k for n, k in enumerate(k for k in range(256) if k not in own)}
    found = []
    for t in texts:
        groups = []
        if t:
            ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            raw_a = [bytes(table[c] for c in a.id_to_token(k)) for k in ids_a]
            raw_b = [bytes([int(b.id_to_piece(k)[1:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
            if b"".join(raw_a) == b"".join(raw_b) == (" " + t).encode():
                ends_a, ends_b = list(accumulate(map(len, raw_a))), list(accumulate(map(len, raw_b)))
                cuts = sorted(set(ends_a) & set(ends_b))
                groups = [([], []) for _ in cuts]
                for side, ids, ends in ((0, ids_a, ends_a), (1, ids_b, ends_b)):
                    for k, e in zip(ids, ends):
                        groups[bisect_left(cuts, e)][side].append(k)
        found.append(groups)
    docs = Counter(p for groups in found for p in {(x, y) for g in groups for x in g[0] for y in g[1]})
    top = defaultdict(int)
    for (x, _), n in docs.items():
        top[x] = max(top[x], n)
    out = []
    for groups in found:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(docs[p] == top[p[0]] for p in links),
                    sum(docs[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment(spark, texts):
    expected = plain_alignment(texts)
    docs = table(spark, texts).repartition(3)
    for step in (alignment.RANGE_BYTES, 300, 41):
        got = {r["_row"]["doc_id"]: tuple(r[n] for n in NUMBERS) for r in alignment.align(docs, A, B, step=step).collect()}
        for i, t in enumerate(texts):
            assert got[i] == expected[i], (step, t)
    assert alignment.align(table(spark, []), A, B).count() == 0


def test_fragments_are_a_monoid():
    r = random.Random(3)
    both = alignment.Tokenizers(A, B)
    for _ in range(40):
        unit = " " + "".join(r.choice("abcé漢-19") for _ in range(r.randint(1, 60)))
        tokens = both.encode([unit])[:4]
        size = len(unit.encode())
        at = sorted({0, size, *(r.randint(0, size) for _ in range(5))})
        parts = [alignment.fragment(*tokens, low, high, both.ids) for low, high in zip(at, at[1:])]
        full = alignment.fragment(*tokens, 0, size, both.ids)
        left = alignment.IDENTITY
        for p in parts:
            left = alignment.composed(left, p)
        right = alignment.IDENTITY
        for p in reversed(parts):
            right = alignment.composed(p, right)
        assert alignment.whole(left) == alignment.whole(right) == alignment.whole(full)
        assert alignment.composed(alignment.IDENTITY, full) == full == alignment.composed(full, alignment.IDENTITY)


def test_units_are_where_both_tokenizers_cut(texts):
    both = alignment.Tokenizers(A, B)
    for t in filter(None, texts):
        units = alignment.UNIT.findall(" " + t)
        assert "".join(units) == " " + t
        a, _, b, _, _, kept = both.encode(units)
        assert kept.all() == ("▁" not in t)
        if kept.all():
            assert a.tolist() == both.a.encode(" " + t, add_special_tokens=False).ids and b.tolist() == both.b.encode(t)


def plain_words(ids, texts):
    counts = Counter()
    for i, t in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate({k: k + 32 for k in range(65, 91)})
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def plain_variants(words):
    near = defaultdict(set)
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].add(b)
            near[b].add(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def variants_of(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_spelling_variants(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abcdeéÿ×") for _ in range(r.randint(6, 12))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "abababab", "bababab"]

    def edited(w):
        k, c = r.randrange(len(w)), r.choice("abcé")
        return r.choice([w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]])

    words = []
    for k, w in enumerate(base):
        some = [edited(w) for _ in range(12)] + [edited(edited(w)) for _ in range(6)]
        words += [w] * (400 if k % 3 == 0 else 30) + [x for x in some for _ in range(r.choice([1, 2, 3, 20, 35]))]
    r.shuffle(words)
    texts = [None, "", "12 34", "Ab", *(r.choice([" ", "-", "\n"]).join(w.upper() if r.random() < .1 and w.isascii() else w for w in words[k:k + 90])
                                        for k in range(0, len(words), 90))]
    ids = [None, 7, 7, *range(len(texts) - 3)]
    expected = plain_variants(plain_words(["" if i is None else i for i in ids], texts))
    assert sum(v[3] > 3 for v in expected.values()) > 50 and any(v[0] != v[1] for v in expected.values() if v[0])
    assert variants_of(spelling.variants(table(spark, texts, ids).repartition(4))) == expected
    assert spelling.variants(table(spark, [])).count() == 0
    assert spelling.variants(table(spark, [None, "", "short words"])).count() == 0


def test_roots_of_long_chains(spark):
    chain = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(19)], "word string, form string")
    assert {r["root"] for r in spelling.roots(chain).collect()} == {"w19"}


def test_pivots_are_the_cheapest_disjoint_pair():
    r = random.Random(1)
    for _ in range(200):
        places = sorted(r.sample(range(9), r.randint(3, 6)))
        prefix = [(k, r.randint(1, 9)) for k in places]
        cost = dict(prefix)
        got = spelling.pivots(prefix, 2)
        assert got[1] - got[0] >= 2
        assert cost[got[0]] + cost[got[1]] == min(cost[x] + cost[y] for x, y in combinations(places, 2) if y - x >= 2)


def test_registered_queries(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    ids, texts = zip(*docs)
    model = SentencePieceProcessor(model_file=B)
    got = {r["doc_id"]: tuple(r) for r in registry.op11_token_counts(spark, sf).collect()}
    for i, t in docs:
        n = len(model.encode(t or ""))
        assert got[i] == (i, len((t or "").encode()), n, n > 4096)
    aligned = registry.op12_token_alignment(spark, sf)
    assert aligned.columns == ["doc_id", *NUMBERS[:6], "groups_sha256"]
    assert {r["doc_id"]: tuple(r[n] for n in NUMBERS) for r in aligned.collect()} == dict(zip(ids, plain_alignment(texts)))
    assert variants_of(registry.op13_spelling_variants(spark, sf)) == plain_variants(plain_words(ids, texts))
