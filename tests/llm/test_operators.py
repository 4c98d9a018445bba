"""The corpus operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import html
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from berthlake.llm import (
    arrays, components, decontamination, html_extraction, jaccard_join, mixing, pii, quality, sharding, suffix_dedup, suffixes, toxicity,
    url_filters,
)

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string"


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"s{k % 3}" if k % 7 else None, len(t or ""), "own") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df, names):
    """The table with a column more for each name, in both cases of letters in turn."""
    return df.withColumns({n.upper() if i % 2 else n: F.concat(F.lit(f"own {n} "), F.col("doc_id")) for i, n in enumerate(names)})


def same_with_clashes(plain, operate, names):
    """The operator gives the same rows beside input columns called like its own ones, and hands those on unchanged."""
    added = [c for c in clashing(plain, names).columns if c not in plain.columns]
    want, got = operate(plain), operate(clashing(plain, names))
    assert set(want.columns) | set(added) == set(got.columns)
    assert sorted(map(str, want.collect())) == sorted(map(str, got.select(*want.columns).collect()))
    for r in got.select("doc_id", *added).collect():
        assert all(r[c] == f"own {c.lower()} {r['doc_id']}" for c in added)


def sentence(r, n):
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    base = [sentence(r, r.randint(30, 200)) for _ in range(40)]
    near = []
    for t in base[:15]:
        words = t.split()
        words[r.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    shared = sentence(r, 70)
    passages = [sentence(r, 60) + " " + shared + " " + sentence(r, 60) for _ in range(6)]
    star = sentence(r, 120).split()
    edits = [" ".join(w if k not in (j * 3, 60 + j) else "x%d" % j for k, w in enumerate(star)) for j in range(18)]
    long = sentence(r, 20_000)
    return [None, "", " \n\t", "one two", "ONE two", "one two", *base, *base[:5], *near, *passages, *edits, long, long + " end",
            "ab " * 300, "\n".join(["same line here"] * 30), "é" * 900]


def test_arrays_words_and_hashes(texts):
    column = pa.array(texts)
    for first, end, data, offsets in arrays.slices(column, 4096):
        found = arrays.words(data, offsets, arrays.NOT_BLANK)
        own = [re.findall("[^\x20\x09-\x0D]+", t or "") for t in texts[first:end]]
        assert np.diff(found.bounds).tolist() == [len(w) for w in own]
        hashes = arrays.word_hashes(data, found).tolist()
        seen = {}
        for h, w in zip(hashes, [w for ws in own for w in ws]):
            assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def shingles(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_join(spark, texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(table(spark, texts).repartition(5)).collect()}
    assert got == {i: (len(sets[i]), root(i)) for i in range(len(texts))}
    kept = jaccard_join.one_of_each_group(table(spark, texts))
    assert kept.columns == table(spark, texts).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(len(texts)) if root(i) == i]


def test_one_of_each_group_loses_no_text(spark):
    r = random.Random(12)
    a, b, c = (sentence(r, 40) for _ in range(3))
    near = a + " more"
    docs = table(spark, [a, a, b, c, near, c, None, None, a], [1, 5, 5, 7, 5, 7, 9, 9, None]).withColumn("_document", F.lit("own"))
    rows = jaccard_join.one_of_each_group(docs.repartition(3))
    assert rows.columns == docs.columns
    assert sorted(((r["doc_id"] or 0), r["text"] or "") for r in rows.collect()) == sorted([(1, a), (5, b), (7, c), (9, ""), (0, a)])
    twice = spark.createDataFrame([(7, c, "en", s, 1, "x") for s in ("s2", "s1")], SCHEMA)
    assert [r["source"] for r in jaccard_join.one_of_each_group(twice).collect()] == ["s1"]


def test_jaccard_join_edge_tables(spark):
    assert jaccard_join.join(table(spark, [])).count() == 0
    got = jaccard_join.join(table(spark, ["a b c", "a b c", "", None], [None, 7, 7, None])).collect()
    assert sorted((r["n_shingles"], r["component_id"] or -1) for r in got) == [(0, -1), (0, 7), (1, 7), (1, 7)]


def test_components_take_few_exchanges_and_no_round_for_stars(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(components, "stored", lambda df, label: rounds.append(label) or df.cache())
    star = spark.createDataFrame([(9, 2), (7, 2), (2, 8), (5, 4), (5, 4), (3, 3)], "a bigint, b bigint")
    got = components.components(star, "a", "b")
    assert sorted(map(tuple, got.collect())) == [(2, 2), (4, 4), (5, 4), (7, 2), (8, 2), (9, 2)]
    assert not rounds  # one round to see that nothing changes, before
    hub = spark.createDataFrame([(50, k) for k in range(100) if k != 50], "a bigint, b bigint")
    assert dict(components.components(hub, "a", "b").collect()) == {k: 0 for k in range(100)}
    assert len(rounds) == 1
    plan = components._stars(hub.filter("a > b"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 7


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(5, 5)]
    got = dict(components.components(spark.createDataFrame(links, "x bigint, y bigint"), "x", "y").collect())
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}}


def test_decontamination(spark, texts):
    items = [" ".join(texts[10].split()[3:25]).replace("a", "A"), "x0", None, "", "one two three four", " ".join(texts[12].split()[:10]), "one two"]
    word = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = {}
    for i, t in enumerate(items):
        w = re.findall(word, (t or "").translate(LOW))
        for k in range(max(1, len(w) - 9)):
            if w:
                windows.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    for block in (decontamination.BLOCK_CHARS, 60):
        got = {r["_row"]["doc_id"]: r for r in decontamination.scan(table(spark, texts), bench, block_chars=block).collect()}
        for i, t in enumerate(texts):
            w, hit, ids = re.findall(word, (t or "").translate(LOW)), set(), set()
            for k in range(len(w)):
                for n in {len(x) for x in windows}:
                    if k + n <= len(w) and tuple(w[k:k + n]) in windows:
                        hit |= set(range(k, k + n))
                        ids |= windows[tuple(w[k:k + n])]
            assert (got[i]["n_words"], got[i]["hit_words"], got[i]["items"]) == (len(w), sorted(hit), sorted(ids))
    clean = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(table(spark, texts), bench).collect()}
    assert 3 not in clean and clean[0] is None and clean[20] == texts[20]
    assert clean[10].split() == texts[10].split()[:3] + texts[10].split()[25:]
    assert decontamination.scan(table(spark, texts), bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontamination.scan(table(spark, []), bench).count() == 0


def test_decontamination_holds_one_python_worker_a_task(spark, texts):
    items = [" ".join(texts[k].split()[a:b]) for k, a, b in ((10, 3, 25), (11, 0, 10), (12, 5, 30), (13, 8, 20), (10, 20, 30))]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = table(spark, texts)

    def workers(df):  # of a task, as nothing is shuffled
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        return plan.count("MapInArrow")

    assert len(decontamination.blocks(bench, 60)) > 2
    scans = [decontamination.scan(docs, bench, block_chars=n) for n in (decontamination.BLOCK_CHARS, 60)]
    clean = [decontamination.decontaminate(docs, bench, block_chars=n) for n in (decontamination.BLOCK_CHARS, 60)]
    assert [workers(df) for df in scans + clean] == [1] * 4
    for whole, parts in (scans, clean):
        assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    hits = {r["_row"]["doc_id"]: r for r in scans[0].collect()}
    assert {10, 11, 12, 13} <= {k for k, r in hits.items() if r["n_hit"]}
    got = {r["doc_id"]: r for r in clean[0].collect()}
    for r in docs.collect():
        found = hits[r["doc_id"]]
        assert (r["doc_id"] in got) == (2 * found["n_hit"] <= found["n_words"])
        if r["doc_id"] in got and not found["n_hit"]:
            assert got[r["doc_id"]] == r
        elif r["doc_id"] in got:
            left = got[r["doc_id"]]
            assert len(left["text"].split()) == found["n_words"] - found["n_hit"] and left["n_chars"] == len(left["text"])


def test_suffix_array_and_repeats():
    r = np.random.default_rng(3)
    for _ in range(150):
        n, letters = int(r.integers(1, 60)), int(r.integers(1, 5))
        a = r.integers(1, letters + 1, n)
        assert suffixes.suffix_array(a, letters).tolist() == sorted(range(n), key=lambda i: tuple(a[i:]))
        b, k = (a + 96).astype(np.uint8), int(r.integers(1, 9))
        raw = b.tobytes()
        expected = [i + k <= n and sum(raw[j:j + k] == raw[i:i + k] for j in range(n - k + 1)) > 1 for i in range(n)]
        assert suffixes.repeated_starts(b, k).tolist() == expected


def test_permuted_prefixes_and_many_names():
    r = np.random.default_rng(4)
    for letters in (3, 600, 3000):  # the last two walk entry by entry
        a = r.integers(1, letters + 1, 300)
        assert suffixes.suffix_array(a, letters).tolist() == sorted(range(300), key=lambda i: tuple(a[i:]))
    data = np.tile(r.integers(97, 100, 60).astype(np.uint8), 5)
    raw, sa = data.tobytes(), suffixes.suffix_array(data.astype(np.uint16) + np.uint16(1), 256)
    prefixes, long = suffixes.permuted_prefixes(data, sa), suffixes.permuted_prefixes(data, sa, 20)
    for above, i in zip(sa.tolist(), sa[1:].tolist()):
        assert long[i] == prefixes[i] if prefixes[i] >= 20 else long[i] < 20
        assert prefixes[i] == next((k for k, (x, y) in enumerate(zip(raw[above:], raw[i:])) if x != y), min(len(raw) - above, len(raw) - i))


def cut_by_hand(raws, size):
    """(bytes left, maximal removed runs) of each text."""
    count = {}
    for b in raws:
        for i in range(len(b) - size + 1):
            count[b[i:i + size]] = count.get(b[i:i + size], 0) + 1
    out = []
    for b in raws:
        cut = np.zeros(len(b) + 1, int)
        for k in range(len(b) - size + 1):
            if count[b[k:k + size]] > 1:
                cut[k:k + size] = 1
        out.append((bytes(c for c, x in zip(b, cut) if not x), int((np.diff(cut, prepend=0) == 1).sum())))
    return out


def same_as_by_hand(docs, texts, size):
    raws = [(t or "").encode() for t in texts]
    got = {r["_row"]["doc_id"]: r for r in suffix_dedup.deduplicate(docs, size).collect()}
    for i, (b, (kept, spans)) in enumerate(zip(raws, cut_by_hand(raws, size))):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) == (len(b), len(b) - len(kept), spans)
        assert got[i]["kept"] == kept and got[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_suffix_dedup(spark, texts):
    same_as_by_hand(table(spark, texts).repartition(4), texts, 400)
    assert suffix_dedup.deduplicate(table(spark, [])).count() == 0


def surrounded(r, lengths, each):
    """Passages of these lengths, each in many surroundings that are no copies, some of which agree for a stretch."""
    out = []
    for n in lengths:
        passage = "".join(r.choices("abcdef ", k=n))
        sides = ["".join(r.choices("abcdef ", k=90)) for _ in range(6)]
        for _ in range(each):
            left, right = ("".join(r.choices("abcdef ", k=r.randint(0, 120))) for _ in range(2))
            out.append(left + r.choice(sides)[-r.randint(1, 90):] * (r.random() < 0.5) + passage
                       + r.choice(sides)[: r.randint(1, 90)] * (r.random() < 0.5) + right)
    return out


def test_suffix_dedup_hot_passages(spark, monkeypatch):
    """Passages shorter and longer than the size, in surroundings that exceed a block: cut into pieces, with the same result."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1500)
    seen = []
    pieces = suffix_dedup.cut_pieces
    monkeypatch.setattr(suffix_dedup, "cut_pieces", lambda size, width: seen.append(width) or pieces(size, width))
    hot = surrounded(random.Random(8), (30, 60, 95, 99, 130, 230), 25) + ["ab" * 300, "ab" * 200, None, ""]
    same_as_by_hand(table(spark, hot).repartition(3), hot, 100)
    assert seen == [suffix_dedup.PIECE, 1]


def test_blocks_fold_their_anchors(monkeypatch):
    """A block is sorted without the bytes of its anchors, and the windows found are those of a count by hand."""
    r, size = random.Random(10), 40
    texts = surrounded(r, (25, 39, 60), 12) + ["ab" * 60, "ab" * 50, "a" * 130, "ab" * 50 + "ba" * 50]
    units = {}
    for owner, batch in enumerate(pa.RecordBatch.from_arrays([pa.array([7]), pa.array([t])], names=["key", "text"]) for t in texts):
        for b in suffix_dedup.segment_rows(size)(iter([batch])):
            for p in b.to_pylist():
                body = texts[owner][p["at"]: p["at"] + p["n"] + size - 1].encode()
                units.setdefault((p["anchor"], p["digest"]), [p["anchor"], p["digest"], p["n"], 0, body])[3] += 1
    units = sorted(map(tuple, units.values()))
    count = collections.Counter()
    for _, _, n, copies, body in units:
        count.update({w: copies * k for w, k in collections.Counter(body[i: i + size] for i in range(n)).items()})
    expected = {(a, d, i) for a, d, n, _, body in units for i in range(n) if count[body[i: i + size]] > 1}
    sorted_bytes, repeated_starts = [], suffixes.repeated_starts
    monkeypatch.setattr(suffixes, "repeated_starts", lambda data, k: sorted_bytes.append(len(data)) or repeated_starts(data, k))
    for gram in (size // 2, 0):
        found = zip(*(c.tolist() for c in suffix_dedup.block_hits(units, size, gram)))
        assert {(a, d, i) for a, d, first, end in found for i in range(first, end)} == expected
    assert 0 < len(expected) < sum(u[2] for u in units)
    assert sorted_bytes[0] == sorted_bytes[1] - len(units) * (size // 2 - suffix_dedup.SIGN_BYTES)


def test_stretches_of_a_long_text(monkeypatch):
    """A text worked on in stretches has every window once, under the same anchors."""
    data = random.Random(9).randbytes(5000).hex().encode()
    column = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([data.decode()])], names=["key", "text"])

    def windows():
        return [(at + k, anchor) for b in suffix_dedup.segment_rows(100)(iter([column])) for at, n, anchor in zip(
            *(b.column(c).to_pylist() for c in ("at", "n", "anchor"))) for k in range(n)]

    whole = windows()
    monkeypatch.setattr(suffix_dedup, "STRETCH", 777)
    assert windows() == whole and [w for w, _ in whole] == list(range(len(data) - 99))


def test_jump_sharding(spark, texts):
    docs = table(spark, texts + texts, list(range(len(texts))) * 2)
    rows = sharding.assign(docs, 8).collect()
    assert len(rows) == 2 * len(texts)
    for k in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(sum(r["shard"] == k for r in rows)))
    for r in rows:
        body = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))
        assert r["grown_shard"] in (r["shard"], 8)
    assert len({(r["doc_id"], r["shard"]) for r in rows}) == len(texts)
    spread = [r["n"] for r in spark.range(20_000).select(sharding.jump_shard(F.col("id"), 8).alias("s")).groupBy("s").agg(
        F.count("*").alias("n")).collect()]
    assert len(spread) == 8 and max(spread) < 1.1 * min(spread)
    assert sharding.assign(table(spark, []), 8).count() == 0
    assert sharding.assign(table(spark, ["a", None], [None, None]), 8).count() == 2


def test_url_filters(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("b.net", "/x", "allow"), ("b.net", "/x", "block"), ("b.net", "/x/y/z", "allow")]
    urls = [None, "", "nothing", "http://net", "http://NET/", "http://a.net/?q", "https://w.example.net/en/1#t", "https://example.net/en",
            "ftp://b.net/xyz", "ftp://b.net/x/y/zz/deep", "://b.net/x/y/", "http://knet/", "http://net./", "http://a.net/" + "p/" * 3000, "http://a.net/"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls + urls)], "page_id int, url string, verdict string")
    got = {r["page_id"]: r for r in url_filters.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert len(got) == 2 * len(urls)
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match("[^/?#]*", rest)[0].translate(LOW)
        path = re.match("[^/?#]*([^?#]*)", rest)[1]
        fits = [(len(h + p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, "allow", None))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, best[2], best[1]), u
    none = url_filters.judge(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert none.filter("verdict <> 'allow' or rule is not null").count() == 0


def test_quality(spark, texts):
    r = random.Random(1)
    bad = [" ".join(w + "%%%" for w in sentence(r, 80).split()) for _ in range(60)]
    docs = table(spark, texts + [sentence(r, 80) for _ in range(60)] + bad)
    n = len(texts)
    labels = spark.createDataFrame([(n + k, int(k < 60), 0) for k in range(120)], "doc_id bigint, quality int, toxic int")
    got = {x["_row"]["doc_id"]: x for x in quality.judge(docs, labels).collect()}
    for i, t in enumerate(texts):
        w = re.findall("[^\x20\x09-\x0D]+", t or "")
        grams = list(zip(w, w[1:], w[2:]))
        many = {k + j for k, g in enumerate(grams) if len(w) < 500 and grams.count(g) > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_dup_lines"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)))
        assert got[i]["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t or ""))
        if len(w) < 500:
            assert got[i]["n_repeat_words"] == len(many)
            assert got[i]["base_failed"] == (len(w) < 50 or 100 * len(many) > 50 * len(w))
    kept = [got[n + k]["kept"] for k in range(120)]
    assert sum(kept[:60]) == 60 and sum(kept[60:]) == 0
    assert quality.judge(docs, labels.limit(0)).filter("not base_failed and not kept").count() == 0
    assert quality.kept_docs(docs, labels).columns == docs.columns


def test_toxicity(spark):
    r = random.Random(2)
    clean = [sentence(r, 60) for _ in range(150)]
    toxic = [" ".join(w if k % 23 else r.choice(["Vile!", "nasty"]) for k, w in enumerate(sentence(r, 60).split(), 1)) for _ in range(60)]
    docs = table(spark, clean + toxic + [None, ""])
    labels = spark.createDataFrame([(i, 1, int(i >= 150)) for i in range(210) if i % 5], "doc_id bigint, quality int, toxic int")
    got = {x["_row"]["doc_id"]: x for x in toxicity.tag(docs, labels).collect()}
    assert sum((got[i]["toxicity"] >= 0.5) == (i >= 150) for i in range(0, 210, 5)) >= 41
    assert got[210]["toxicity"] < 0.5 and got[211]["toxic_spans"] == []
    span = got[151]["toxic_spans"][0]
    assert toxic[1][span["start"]: span["end"]] in ("Vile", "nasty")
    assert toxicity.tag(docs, labels.limit(0)).agg(F.max("toxicity")).first()[0] < 0.01


def test_toxicity_learns_nothing_from_held_out_labels(spark):
    r = random.Random(6)
    clean = [sentence(r, 60) for _ in range(100)]
    toxic = [" ".join(w if k % 23 else r.choice(["Vile!", "nasty"]) for k, w in enumerate(sentence(r, 60).split(), 1)) for _ in range(50)]
    docs = table(spark, clean + toxic)
    among = F.col("_id") % 5 != 0

    def scores(held):
        labels = [(i, 1, held if i % 5 == 0 else int(i >= 100)) for i in range(150)]
        labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
        return {x["_row"]["doc_id"]: x["toxicity"] for x in toxicity.tag(docs, labels, among=among).collect()}

    assert scores(0) == scores(1)


def test_chain_marginals_equal_enumeration():
    from itertools import product
    r = np.random.default_rng(0)
    bounds, e, a = np.array([0, 4, 4, 9]), r.normal(size=9), r.normal(size=(2, 2))
    got, pairs = toxicity.chains(e, bounds, a, pairs=True)
    expected, steps = np.zeros(9), np.zeros((2, 2))
    for x, y in ((0, 4), (4, 9)):
        paths = {p: np.exp(sum(e[x + k] * t for k, t in enumerate(p)) + sum(a[s, t] for s, t in zip(p, p[1:]))) for p in product((0, 1), repeat=y - x)}
        z = sum(paths.values())
        for p, w in paths.items():
            expected[x:y] += np.array(p) * w / z
            for s, t in zip(p, p[1:]):
                steps[s, t] += w / z
    assert np.allclose(got, expected) and np.allclose(pairs, steps)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<div class="cookie-notice">We use cookies, ok.</div><article><h1>Title &amp; more</h1><p>First  para,\nwith <b>bold</b> &lt;x&gt; text.</p><div class="ad">Buy now.</div>
<p>Second para.<p>Third para, unclosed.<section class="comments"><p>Nice post, really great.</p></section></article><aside><p>Side text.</p></aside>
<form><p>Your name</p></form><script>var a = "<p>no</p>";</script><footer>&copy; me</footer></body></html>"""


def test_html_extraction(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, "u", "<p>a<br>b < c<!-- x"), (1, "u", PAGE)],
                                  "page_id int, url string, html string")
    got = {r["_row"]["page_id"]: r["main_text"] for r in html_extraction.extract(pages).collect()}
    assert got[1] == "Title & more First para, with bold <x> text. Second para. Third para, unclosed."
    assert got[2] == "" and got[3] == ""


LONG = "A paragraph of the article, with commas, and some more words to make a whole sentence of it."
WRAPPED = {
    "bad word in a layout name": '<div class="page with-sidebar"><div class="post-content"><p>%s</p></div><div class="sidebar"><p>%s</p></div></div>',
    "article in a header": '<div class="layout-header"><article><p>%s</p></article></div><div class="footer"><p>%s</p></div>',
    "names that say both": '<article><div class="content share-story"><p>%s</p></div><div class="share"><p>%s</p></div></article>',
    "page in one form": '<form id="all"><article><p>%s</p></article><p><a href="/">%s</a></p></form>',
    "comments called content": '<article><p>%s</p></article><div class="comments"><div class="content"><p>%s</p></div></div>',
    "comments as articles": '<main><p>%s</p></main><section class="comments"><article class="comment"><p>%s</p></article></section>',
    "article in a banner": '<div class="banner"><main><p>%s</p></main></div><nav><ul><li>%s</li></ul></nav>',
}
WEIGHTS = np.array([0.44, 0.85, -1.92, 0.67, 0.0, 0.0])  # as fitted on the given pages


@pytest.mark.parametrize("name", WRAPPED)
def test_html_containers(name):
    assert html_extraction.main_text(WRAPPED[name] % (LONG, LONG.upper()), WEIGHTS) == LONG


def test_html_cut_decides_where_names_do_not():
    links = "".join(f'<li><a href="/{k}">Link {k}</a></li>' for k in range(6))
    # nothing tells: the text and the neighbours do; a short line between paragraphs follows these
    plain = f"<div><ul>{links}</ul></div><div><p>{LONG}</p><p>{LONG}</p><p>So it was</p><p>{LONG}</p><p>{LONG}</p></div><div><ul>{links}</ul></div>"
    assert html_extraction.main_text(plain, WEIGHTS) == " ".join([LONG, LONG, "So it was", LONG, LONG])
    # text against container: alone it goes, among paragraphs of the article it stays
    link = '<p><a href="/x">see there</a></p>'
    strong = WEIGHTS * 2
    assert html_extraction.main_text(f"<article>{link}</article>", strong) == ""
    assert html_extraction.main_text(f"<article><p>{LONG}</p>{link}<p>{LONG}</p></article>", strong) == f"{LONG} see there {LONG}"


def test_html_fit_takes_large_pages(spark):
    large = "<article>" + f"<p>{LONG}</p>" * 1500 + "</article><nav><ul>" + '<li><a href="/">Go on</a></li>' * 300 + "</ul></nav>"
    pages = spark.createDataFrame([(k, "u", large) for k in range(3)] + [(None, None, None)], "page_id int, url string, html string")
    weights = html_extraction.fit(pages)
    assert weights.tolist() != html_extraction.PRIOR and weights[2] < 0 < weights[1]
    assert html_extraction.fit(pages.limit(0)).tolist() == html_extraction.PRIOR


def test_html_query_on_given_pages(spark):
    """In the given pages, the article element and nothing else is the main text."""
    from berthlake.llm import registry

    sf = "/root/testdata/sf0.001"
    got = {r["page_id"]: r for r in registry.QUERIES["op9_html_extraction"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages) > 0
    for page in pages:
        inner = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        inner = re.sub("<(script|style).*?</\\1>|<!--.*?-->", "", inner, flags=re.S)
        text = " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("</?(p|h1|br|li|ul|div)[^>]*>", " ", inner))).split())
        r = got[page["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (page["url"], text, len(text))


def test_least_cut_is_least():
    from itertools import product
    r = random.Random(4)
    for _ in range(60):
        n = r.randint(1, 8)
        score = [r.uniform(-2, 2) for _ in range(n)]
        edges = {(i, j): r.uniform(0, 1.5) for i in range(n) for j in range(i + 1, n) if r.random() < 0.6}

        def cost(side):
            return sum(max(0, s) if not x else max(0, -s) for s, x in zip(score, side)) + sum(w for (i, j), w in edges.items() if side[i] != side[j])

        assert cost(html_extraction.least_cut(score, edges)) <= min(map(cost, product((True, False), repeat=n))) + 1e-9


def test_pii(spark):
    cards = "4111 1111 1111 1111"
    texts = [None, "", f"mail a.b@c.example.com_x@y.org and {cards} at 10.0.0.300 or 1.2.3.4.5.6.7.8 é +49 (30) 123-4567 end", "x" * 50_000 + "@a.b",
             "9" * 3000, "a@b.c " * 700, "+1 2", "4111-1111-1111-1112"]
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(s):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0

    def valid(kind, body):
        n = re.sub("[^0-9]", "", body)
        return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in body.split(".")), "card": 16 <= len(n) <= 19 and luhn(n),
                "phone": 8 <= len(n) <= 15}[kind]

    got = {r["doc_id"]: r for r in pii.find(table(spark, texts)).collect()}
    for i, t in enumerate(texts):
        # the long run of letters would make the plain pattern slow; it is one address from its start
        plain = [("email", 0, len(t))] if i == 3 else [(k, m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, t or "") if valid(k, m[0])]
        assert [tuple(s) for s in got[i]["pii_base"]] == plain, i
        assert {tuple(s) for s in got[i]["pii_spans"]} >= set(plain)
    clean = {r["doc_id"]: r["text"] for r in pii.redact(table(spark, texts)).collect()}
    assert clean[0] is None and "@" not in clean[2] and cards not in clean[2] and clean[2].endswith("[PHONE] end")
    assert pii.find(table(spark, [])).count() == 0


def test_pii_adds_what_the_base_patterns_miss(spark):
    r = random.Random(8)

    def card():
        d = [r.randrange(10) for _ in range(15)]
        odd = sum(sum(divmod(2 * x, 10)) if i % 2 == 0 else x for i, x in enumerate(d))
        return "".join(map(str, d)) + str(-odd % 10)

    made = {
        "email": lambda: f"{sentence(r, 1).replace('é', 'e')}.{r.randrange(99)}@mail{r.randrange(9)}.example.com",
        "ip": lambda: ".".join(str(r.randrange(256)) for _ in range(4)),
        "card": card, "phone": lambda: f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}"}
    learned = [f"{sentence(r, 5)} {m()} {sentence(r, 5)} Version 2.{r.randrange(9)} {sentence(r, 3)}" for m in made.values() for _ in range(40)]
    planted = [("phone", "49 30 1234567"), ("phone", "(830) 555-5433"), ("email", "jane.roe [at] harbour [dot] org"), ("email", "jane.roe(at)harbour.org"),
               ("ip", "10,0,0,1"), ("card", "4111/1111/1111/1111"), ("card", "4111.1111.1111.1111"), ("email", "a@b.c [dot] org")]
    others = ["2019-05-17", "1999-2003", "isbn 978-3-16-148410-0", "token = 24be64439e3e49cf46b2d7", "4111/1111/1111/1112", "look at example.com", "300,1,2,3"]
    texts = [f"abc {v} cab" for _, v in planted] + [f"abc {v} cab" for v in others]
    model = pii.fit(table(spark, learned))
    got = [r["pii_spans"] for r in pii.find(table(spark, texts), model).orderBy("doc_id").collect()]
    for (kind, v), spans in zip(planted, got):
        assert (kind, 4, 4 + len(v)) in {tuple(s) for s in spans}, v
    assert got[len(planted):] == [[]] * len(others)


def test_mixing(spark):
    rows = [(k, "w " * (1 + k % 5), "en", s, 0, "x") for s, n in (("big", 300), ("mid", 60), ("small", 20)) for k in range(n)] + [(1, None, None, None, 0, "x")] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs).collect()
    n = {s: sum(r["source"] == s for r in got) for s in ("big", "mid", "small", None)}
    assert n["big"] == 300 and n["mid"] >= 60 and n["small"] >= 20 and n[None] >= 2
    assert {r["doc_id"] for r in got if r["source"] == "big"} == set(range(300))
    own = {s: sum(r["n_tokens"] for r in got if r["source"] == s) for s in ("big", "mid", "small")}
    full = {s: sum(1 + k % 5 for k in range(c)) for s, c in (("big", 300), ("mid", 60), ("small", 20))}
    repeats = {s: own[s] / full[s] for s in own}
    assert max(repeats.values()) <= 2.3 and repeats["small"] > repeats["mid"] > repeats["big"] == 1.0
    half = mixing.mix(docs, budget=400, max_repeats=None, entropy=0.9).collect()
    assert 395 <= sum(r["n_tokens"] for r in half) <= 420
    assert mixing.mix(docs.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as c

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for name, stage in c.STAGES:
        seen.append(stage(spark, seen[-1], sf).cache())
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert all(a >= b for a, b in zip(ids, ids[1:])) and ids[1] < ids[0] and ids[2] < ids[1]
    assert all(d.columns == docs.columns for d in seen[1:-1])
    groups = jaccard_join.join(seen[1]).groupBy("component_id").count().count()
    assert seen[2].count() == groups
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert decontamination.scan(seen[3], bench).filter("n_hit > 0").count() == 0
    assert ids[3] == ids[4] == ids[5] and seen[5].count() == seen[4].count() > seen[3].count()
    again = c.run(spark, sf)
    assert again.count() == seen[5].count()
    for d in seen[1:]:
        d.unpersist()


def test_registered_sql(spark):
    from compare import compare, connect

    from berthlake.llm import registry
    from berthlake.registry import Query

    con = connect("/root/testdata/sf0.001")
    for name in registry.SQL:
        count, problem = compare(spark, con, Query(registry.QUERIES[name], registry.SQL[name]), "/root/testdata/sf0.001")
        assert count and not problem, (name, problem)


def test_clashing_input_columns(spark, texts):
    """Input columns called like the native operators' own ones."""
    docs = table(spark, [*texts[:12], "mail me at a.b@c.example or +49 30 1234567", "", texts[0]])
    same_with_clashes(docs, lambda d: sharding.assign(d, 4), ["_slice", "_rows", "_first", "_at"])
    same_with_clashes(docs, mixing.mix, [
        "_source", "_tokens", "_budget", "_full", "_rest", "_slices", "_u", "_slice", "_sum", "_first", "_before"])
    none = pii.Model([], {})  # base spans only, so that nothing is fitted here
    same_with_clashes(docs, lambda d: pii.find(d, none), ["_base", "_wide", "_once", "_text"])
    same_with_clashes(docs, lambda d: pii.redact(d, none), ["_s", "pii_base", "pii_spans", "_base", "_wide", "_once", "_text"])
    pages = docs.withColumn("url", F.concat(F.lit("http://a.example.com/de/"), F.col("doc_id")))
    rules = spark.createDataFrame([("example.com", "/de/1", "block")], "host string, path string, verdict string")
    names = ["_url", "_best", "_rule", "_rule_host", "_rule_path", "_verdict", "_digest", "_short", "_labels", "_folders", "_path",
             "_expr", "_asked", "_host"]
    same_with_clashes(pages, lambda d: url_filters.judge(d, rules), names)


def test_keys_called_like_own_columns(spark, texts):
    docs = table(spark, texts[:8])
    want = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.assign(docs, 4).collect()}
    renamed = docs.withColumnsRenamed({"doc_id": "_at", "text": "_slice"})
    got = sharding.assign(renamed, 4, key="_at", text="_slice")
    assert {"_at", "_slice"} <= set(got.columns) and {(r["_at"], r["shard"], r["slot"]) for r in got.collect()} == want
