"""Corpus operators against brute-force versions, with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scenequill.llm import chain_dedup, exact_dedup, line_dedup, lyndon_suffix_array, mixing, packing, queries, simhash, suffix_dedup, suffix_rules, token_counts, token_files, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, kept string, fp int, size int"


@pytest.fixture(scope="module")
def rows():
    random.seed(4)
    word = lambda: "".join(random.choice("abcdeé") for _ in range(random.randint(2, 7)))
    vocab = [word() for _ in range(300)]
    line = lambda n: " ".join(random.choice(vocab) for _ in range(n))
    common = [line(12) for _ in range(3)]
    passage = line(80)
    out = [(None, "null id"), (1, None), (2, ""), (3, "A"), (4, "a"), (5, " \n\n"), (6, "x" * 5000), (7, "ab " * 4000)]
    for i in range(10, 90):
        parts = [line(random.randint(3, 30)) for _ in range(random.randint(1, 6))]
        if i % 3 == 0:
            parts.insert(1, "  " + random.choice(common).upper() + "\t")
        if i % 5 == 0:
            w = passage.split()
            w[random.randint(10, 70)] = "edit"
            parts.append(" ".join(w))
        out.append((i, "\n".join(parts)))
    out += [(100 + i, out[20 + i][1]) for i in range(5)] + [out[30], out[30]] + [(10, "same id, other text")]
    return [(i, t, None, random.choice(["a", "b", None]), 3, "clash", None, 1, 2) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def sf(spark, docs, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{d}/documents.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    return d


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_one_row_per_row_and_empty(spark, sf, empty, rows, name):
    out = queries.QUERIES[name](spark, sf)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert set(ids) == {r[0] for r in rows}
    if not name.startswith("op4"):
        assert collections.Counter(ids) == collections.Counter(r[0] for r in rows)
    none = queries.QUERIES[name](spark, empty)
    assert none.count() == 0
    assert none.columns == out.columns


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf_dir, same, name):
    same(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name])


def test_suffix_array():
    random.seed(1)
    for _ in range(3000):
        s = [random.randint(0, random.choice([0, 1, 4])) for _ in range(random.randint(0, 14))]
        assert lyndon_suffix_array.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def brute_suffix(rows, length):
    seen, out = {}, []
    for i, t in sorted({(r[0] if r[0] is not None else -1, (r[1] or "").encode()) for r in rows}, key=lambda x: x[0]):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if t[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.setdefault(t[p : p + length], 1)
        spans = sum(1 for j in range(len(t)) if gone[j] and (not j or not gone[j - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("how", ["plain", "crowded", "hot", "chunks"])
def test_suffix_dedup(spark, rows, docs, monkeypatch, how):
    one = [r for r in rows if r[1] != "same id, other text"]
    plain, anchors = suffix_dedup._marks, suffix_dedup.anchors
    if how == "crowded":  # every anchor takes the path of those with very many contexts
        monkeypatch.setattr(suffix_dedup, "_marks", lambda length, width: plain(length, width, 0))
    if how == "hot":  # every other anchor is dealt by text as well
        texts = [(r[1] or "").encode() for r in one]
        h = np.unique(np.concatenate([anchors(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 100)[1] for t in texts])).view(np.int64)
        monkeypatch.setattr(suffix_dedup, "hot_keys", lambda *a: h[::2])
    if how == "chunks":  # a very long text goes through in parts
        for b in (np.frombuffer(t.encode(), np.uint8) for t in ("ab cd " * 3000, " ".join(str(i * i) for i in range(4000)))):
            o = np.array([0, 4000, len(b)])
            whole = anchors(b, o, 100)
            monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
            assert all((x == y).all() for x, y in zip(whole, suffix_dedup.anchors(b, o, 100), strict=True))
            monkeypatch.setattr(suffix_dedup, "CHUNK", 1 << 23)
        return
    d = spark.createDataFrame(one, SCHEMA).repartition(3)
    out = suffix_dedup.suffix_dedup(d, 100).select(F.coalesce("_id", F.lit(-1)), "n_bytes", "n_removed", (F.size("spans") / 2).cast("long"), F.sha2("kept", 256)).distinct().collect()
    got = sorted((-1 if r[0] == -(1 << 63) else r[0], *r[1:]) for r in out)
    assert got == brute_suffix(one, 100)


def test_a_repeated_row_is_no_earlier_copy_of_itself(spark):
    text = " ".join(f"word{i}" for i in range(60))
    d = spark.createDataFrame([(1, text), (1, text), (2, text + " and more")], "doc_id long, text string")
    got = sorted((r["_id"], r["n_removed"]) for r in suffix_dedup.suffix_dedup(d, 100).collect())
    assert got == [(1, 0), (1, 0), (2, len(text))]


def test_exact_dedup_index_continues(spark, docs, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    first = exact_dedup.exact_dedup(docs, index)
    texts = [re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "") for r in first.collect()]
    assert first.columns == docs.columns
    assert len(texts) == len(set(texts))
    again = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    assert exact_dedup.exact_dedup(docs, again).count() == 0


def test_simhash(spark, docs):
    rows, component = simhash.op5_links(docs)
    f = {r["fp"] for r in rows.collect()}
    got = {r["fp"]: r["component_id"] for r in component.collect()}
    near = {a: {b for b in f if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3} for a in f}
    for a in f:
        assert all(got[a] == got[b] for b in near[a])
    reach = {}
    for a in sorted(f):
        if a not in reach:
            todo = {a}
            while todo:
                x = todo.pop()
                reach[x] = a
                todo |= {b for b in near[x] if b not in reach}
    assert len(set(reach.values())) == len({(reach[a], got[a]) for a in f})


def test_simhash_finds_links_in_long_runs():
    fp = np.arange(3000, dtype=np.int64) * 3
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(3000, np.int64)), pa.array(fp), pa.array(fp)], ["key", "fp", "node"])
    out = list(simhash._link(3, False, True)(iter([batch.slice(i, 700) for i in range(0, 3000, 700)])))
    parent = {int(x): int(x) for x in fp}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for b in out:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            assert (u ^ v).bit_count() <= 3
            parent[root(u)] = root(v)
    assert len({root(int(x)) for x in fp}) == 1


def test_near_dedup_keeps_one_of_each_text(spark, docs):
    out = simhash.near_dedup(docs)
    assert out.columns == docs.columns
    kept = [r["text"] for r in out.collect()]
    assert len(kept) == len(set(kept))


def five_word_sets(texts):
    w = {i: (t or "").lower().split() for i, t in texts.items()}
    return {i: {tuple(x[j : j + 5]) for j in range(max(1, len(x) - 4))} for i, x in w.items()}


def near_copy_groups(texts):
    """The smallest id of each text's group, by Jaccard similarity of all pairs."""
    s = five_word_sets(texts)
    root = {i: i for i in s}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(s):
        for j in sorted(s):
            if i < j and 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: top(i) for i in s}


def edited(words, n, rng):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.random()}"
    return out


def test_near_dedup_finds_pairs_at_the_edge(spark):
    rng = random.Random(7)
    texts, similar = {}, {}
    for i in range(400):
        w = [f"v{rng.randrange(5000)}" for _ in range(rng.randint(150, 400))]
        texts[2 * i], texts[2 * i + 1] = " ".join(w), " ".join(edited(w, round(len(w) * rng.uniform(0.004, 0.04)), rng))
    s = five_word_sets(texts)
    for i in range(400):
        similar[i] = len(s[2 * i] & s[2 * i + 1]) / len(s[2 * i] | s[2 * i + 1])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"] for r in simhash.near_dedup(docs).collect()}
    assert kept >= {2 * i for i in range(400)} | {2 * i + 1 for i in range(400) if similar[i] < 0.8}
    for low, high, least in ((0.8, 0.85, 0.95), (0.85, 0.9, 0.97), (0.9, 1, 0.99)):
        pairs = [i for i in range(400) if low <= similar[i] < high]
        recall = sum(2 * i + 1 not in kept for i in pairs) / len(pairs)
        print(f"recall at {low} to {high}: {recall:.3f} of {len(pairs)} pairs")
        assert recall >= least


def test_near_dedup_of_large_groups(spark):
    rng = random.Random(8)
    base = [f"v{rng.randrange(5000)}" for _ in range(300)]
    texts = {0: " ".join(edited(base, 30, rng)), 1: " ".join(base)}
    for i in range(2, 90):
        texts[i] = " ".join(edited(base, 3 if i % 3 else 6, rng))  # the 6s are alike to base, not to one another
    for i in range(90, 150):
        texts[i] = " ".join(edited(base, 16, rng))  # alike to nothing
    texts[150] = " ".join(base[:250])
    want = set(near_copy_groups(texts).values())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.near_dedup(docs).collect()} == want
    assert len(want) == 62


def test_mixing_targets(spark, docs):
    out = mixing.mix_plan(docs).collect()
    total = sum(r["size"] for r in out)
    by = {}
    for r in out:
        s = by.setdefault((r["source_size"], r["target"]), [0, 0])
        s[0] += r["copies"] * r["size"]
        s[1] = max(s[1], r["size"])
        assert r["copies"] * r["size"] <= 2 * r["size"]
    assert sum(t for _, t in by) == pytest.approx(1.5 * total)
    assert all(abs(got - target) <= most for (_, target), (got, most) in by.items())
    assert mixing.mix(docs).columns == docs.columns


def test_quality_counts(spark, docs, rows):
    t = [r[1] or "" for r in rows]
    f = suffix_rules.features(pa.array(t), 4)
    for i, x in enumerate(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        hit = set()
        for j in range(len(w) - 2):
            if c[tuple(w[j : j + 3])] > 1:
                hit |= {j, j + 1, j + 2}
        assert (f["n_words"][i], f["word_chars"][i], f["n_repeat_words"][i]) == (len(w), sum(map(len, w)), len(hit))
    assert suffix_rules.quality_filter(docs).columns == docs.columns
    kept = suffix_rules.quality(docs).where("kept").count()
    assert suffix_rules.quality_filter(docs).count() == kept


def test_repeats_reject_what_base_passes(spark):
    new = (f"w{i}" for i in range(10**6))
    text = lambda *parts: " ".join(x for p in parts for x in (p if isinstance(p, list) else [next(new) for _ in range(p)]))
    a, b, c = ([next(new) for _ in range(n)] for n in (45, 12, 9))
    texts = {
        1: text(100),
        2: text(20, a, 100, a, 20),  # 90 of 230 words in a repeat of 45: covered and longest
        3: text(b, 20, b, 20, b, 20, b, 60),  # 48 of 168 words, the longest 12: covered alone
        4: text(a, 200, a, 160),  # 90 of 450 words, the longest 45: at the limits
        5: text(a, 200, a, 140),  # 90 of 430 words, the longest 45: over both
        6: text(c, 20, c, 20, c, 20),  # under ten words
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["_id"]: (r["base_failed"], r["kept"]) for r in suffix_rules.quality(docs).collect()}
    assert got == {1: (False, True), 2: (False, False), 3: (False, False), 4: (False, True), 5: (False, False), 6: (False, True)}
    assert {r["doc_id"] for r in suffix_rules.quality_filter(docs).collect()} == {1, 4, 6}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_encode_like_whole_texts(rows, name):
    random.seed(3)
    signs = ["a", "Zx", ".", ",", " ", " ", "\n", "\t", "'s", "é", " ", "　", "日", "😀", "1", "  ", ", ", "́", "\x1c", "\x85", "«"]
    t = ["".join(random.choice(signs) for _ in range(random.randint(0, 30))) for _ in range(4000)] + [r[1] or "" for r in rows]
    e = tokens.encoder(tokens.vocabulary(name))
    ids, at = e.texts(pa.array(t))
    for i, x in enumerate(e.tokenizer.encode_batch(t, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == x.ids, t[i]


def test_packing_plan_fills_windows():
    random.seed(2)
    for _ in range(100):
        w = random.choice([16, 64, 2048])
        h = {random.randint(1, w): random.choice([1, 2, 5, 1000]) for _ in range(random.randint(1, 20))}
        p = packing.plan(h, w)
        total = sum(a * b for a, b in h.items())
        assert (p[:, 2] * p[:, 5]).sum() == total
        assert max(p[:, 8] + (p[:, 6] + p[:, 2] - 1) // p[:, 7]) + 1 == -(-total // w)


def test_packing(spark, docs, rows):
    tok = tokens.encoder(tokens.vocabulary("byte_bpe_50k.json")).tokenizer
    want = collections.Counter()
    for r in rows:
        want[r[0]] += len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1
    out = packing.pack(docs)
    got, seqs = collections.Counter(), collections.defaultdict(list)
    for r in out.collect():
        assert zlib.crc32(np.frombuffer(r["ids"], "<u2").astype("<u4")) == r["ids_crc32"]
        got[None if r["_id"] == -(1 << 63) else r["_id"]] += r["length"]
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.sequences(out).where("length(ids) <> 2 * n_tokens").count() == 0


def test_shards_round_trip():
    rng = np.random.default_rng(0)
    for bits in (1, 7, 16, 17, 32):
        ids = rng.integers(0, 2**bits, 9001, dtype=np.uint64).astype(np.uint32)
        at = np.array([0, 5, 5, 4096, 9001])
        s = token_files.Shard(token_files.write_shard(np.arange(4), at, ids, bits))
        assert all((s.document(i) == ids[at[i] : at[i + 1]]).all() for i in range(4))


def test_token_trees():
    enc = tokens.encoder(tokens.vocabulary("byte_bpe_50k.json"))
    random.seed(5)
    signs = ["a", "b", "Zx", ".", ",", " ", " ", "\n", "'s", "é", "1", "  ", ", ", " word"]
    for _ in range(600):
        t = "".join(random.choice(signs) for _ in range(random.randint(0, 40)))
        b = t.encode()
        starts, count, _ = enc.units(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        tree = token_counts.TokenTree(b, np.diff(np.append(starts, len(b))), count, enc)
        for _ in range(6):
            i = random.randint(0, len(t))
            j = random.randint(i, min(len(t), i + random.choice([0, 1, 10])))
            new = "".join(random.choice(signs) for _ in range(random.randint(0, 3)))
            tree.replace(len(t[:i].encode()), len(t[:j].encode()), new.encode())
            t = t[:i] + new + t[j:]
            assert tree.total == len(enc.tokenizer.encode(t, add_special_tokens=False).ids)
            assert b"".join(u for u, _ in tree.units()) == t.encode() and int(tree.bytes[1]) == len(t.encode())


def test_kept_trees_take_a_second_round_of_edits(spark):
    """What a round leaves is edited again, and only near the new edits is anything encoded."""
    enc = tokens.encoder(tokens.vocabulary("byte_bpe_50k.json"))
    text = " ".join(f"word{i} mail a{i}@b.org" if i % 40 == 0 else f"word{i}" for i in range(400))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "plain")], "doc_id long, text string")
    first = token_counts.stage(token_counts.apply_edits(token_counts.token_trees(docs)), "trees")

    def second(t: bytes) -> list:
        at = t.find(b"word77 ")
        return [(at, at + 6, b"other text, quite")] if at >= 0 else []

    got = {r["_id"]: r for r in token_counts.apply_edits(first, edits=second).collect()}
    b = text.encode()
    for rule in (token_counts.mask_edits, second):
        for x, y, new in rule(b):
            b = b[:x] + new + b[y:]
    assert got[1]["text"] == b and got[1]["n_tokens"] == len(enc.tokenizer.encode(b.decode(), add_special_tokens=False).ids)
    assert sum(got[1]["tokens"]) == got[1]["n_tokens"] and sum(got[1]["sizes"]) == len(b) and max(got[1]["sizes"]) < 40
    assert 0 < got[1]["n_bytes_reencoded"] < 60 and got[2]["n_tokens"] == 0 and got[3]["n_edits"] == 0


def test_a_mapped_shard_gives_any_document(tmp_path):
    ids = np.arange(70_000, dtype=np.uint32) % 50_000
    at = np.array([0, 4095, 4097, 4097, 60_000, 70_000])
    (tmp_path / "shard").write_bytes(token_files.write_shard(np.array([5, 6, 7, 8, 9]), at, ids, 16))
    s = token_files.Shard(np.memmap(tmp_path / "shard", np.uint8, "r"))
    assert s.doc_ids.tolist() == [5, 6, 7, 8, 9] and all((s.document(i) == ids[at[i] : at[i + 1]]).all() for i in range(5))


def test_edit_distance_and_chains():
    def slow(x, y):
        p = list(range(len(y) + 1))
        for i, a in enumerate(x):
            q = [i + 1]
            for j, b in enumerate(y):
                q.append(min(q[j] + 1, p[j + 1] + 1, p[j] + (a != b)))
            p = q
        return p[-1]

    random.seed(1)
    for _ in range(300):
        x, y = ([random.randint(0, 3) for _ in range(random.randint(0, 70))] for _ in range(2))
        assert chain_dedup.edit_distance(x, y) == slow(x, y)
    assert chain_dedup.chains([0, 10, 20, 25], [100, 110, 5, 125], [5.0] * 4) == [(0, 30, 100, 130, 15.0), (20, 25, 5, 10, 5.0)]
    assert [c[:4] for c in chain_dedup.chains([0, 200, 210], [0, 200, 210], [60.0] * 3)] == [(200, 215, 200, 215), (0, 5, 0, 5)]  # a gap parts


def test_fuzzy_passages(spark, sf, rows):
    out = {r["doc_id"]: r for r in chain_dedup.op8_chain_dedup(spark, sf).collect()}
    with_passage = [i for i in range(10, 90) if i % 5 == 0]
    assert all(out[i]["n_repeated_words"] >= 50 for i in with_passage[1:] if i != 10)
    assert all(out[i]["partners"] == [] for i in range(11, 90) if i % 5 and i < 100 and not out[i]["n_repeated_words"])


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    quality = cp.STAGES[0][1](spark, docs, sf_dir)
    assert quality.columns == columns
    assert 0 < quality.count() <= n
    packed = cp.run(spark, sf_dir)
    spread = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n < 2048").count()
    assert spread <= 1


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_hold_the_ids_of_whole_texts(spark, sf, rows):
    tok = tokens.encoder(tokens.vocabulary("byte_bpe_50k.json")).tokenizer
    texts = collections.defaultdict(list)
    for r in rows:
        texts[r[0]].append([*tok.encode(r[1] or "", add_special_tokens=False).ids, 1])
    left = collections.Counter({i: sum(map(len, t)) for i, t in texts.items()})
    for r in packing.op4_packing(spark, sf).collect():
        own = [t for t in texts[r["doc_id"]] if len(t) == r["doc_tokens"]]
        assert any(crc(t[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] for t in own)
        left[r["doc_id"]] -= r["length"]
    assert not any(left.values())


def test_token_files_hold_the_ids_of_whole_texts(spark, sf, rows):
    tok = tokens.encoder(tokens.vocabulary("word_bpe_49k.json")).tokenizer
    want = collections.Counter()
    for r in rows:
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 1]
        want[r[0], len(ids), crc(ids)] += 1
    out = sorted(token_files.op9_token_files(spark, sf).collect(), key=lambda r: r["start"])
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == want
    at = 0
    for r in out:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in out]
    assert ids == sorted(ids)


def test_fingerprints(spark, sf, rows):
    from xxhash import xxh64_intdigest

    want = collections.Counter()
    for r in rows:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        h = [xxh64_intdigest(" ".join(s).encode(), 42) for s in (zip(w, w[1:], w[2:]) if len(w) > 2 else [w] if w else [])]
        want[r[0], f"{sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)):016x}"] += 1
    got = simhash.op5_simhash_near_dedup(spark, sf).collect()
    assert collections.Counter((r["doc_id"], r["fingerprint"]) for r in got) == want


def test_quality_contract(spark, sf, rows):
    want = collections.Counter()
    for r in rows:
        t = r[1] or ""
        w = WORDS.findall(t)
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        rep = len({j + k for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for k in range(3)})
        base = len(w) < 50 or 100 * rep > 50 * len(w)
        want[r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep, base] += 1
    got = suffix_rules.op7_quality_rules(spark, sf).collect()
    assert collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    assert not any(r["base_failed"] and r["kept"] for r in got)


def test_edited_counts(spark, sf, rows):
    tok = tokens.encoder(tokens.vocabulary("byte_bpe_50k.json")).tokenizer
    count = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    want = collections.Counter()
    for r in rows:
        b = t = (r[1] or "").encode()
        for x, y, new in token_counts.mask_edits(t):
            b = b[:x] + new + b[y:]
        want[r[0], count(t.decode()), count(b.decode())] += 1
    got = token_counts.op10_token_counts(spark, sf).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["n_tokens_edited"]) for r in got) == want


def brute_force_quality(t):
    w = WORDS.findall(t or "")
    n = len(w)

    def hit(k):
        c = collections.Counter(tuple(w[j : j + k]) for j in range(n - k + 1))
        return {j + i for j in range(n - k + 1) if c[tuple(w[j : j + k])] > 1 for i in range(k)}

    longest = 9  # what repeats at k words repeats at fewer
    while hit(longest + 1):
        longest += 1
    longest = longest if longest > 9 else 0
    return n >= 50 and 2 * len(hit(3)) <= n and len(hit(10)) <= 0.2 * n and longest <= 0.1 * n


def test_pipeline_rows_against_brute_force(spark, tmp_path):
    import duckdb

    import corpus_pipeline as cp

    rng = random.Random(11)
    words = lambda n: [f"v{rng.randrange(4000)}" for _ in range(n)]
    texts = {i: words(rng.randint(60, 500)) for i in range(100)}
    for i in range(100, 120):
        texts[i] = texts[i - 100]  # equal texts: the larger doc_id stays
    for i in range(120, 160):
        texts[i] = edited(texts[20 + i % 20], 1 if i % 2 else 2, rng)  # near copies, or not quite, of 20 to 39
    for i in range(160, 170):
        texts[i] = words(30)  # too few words
        texts[i + 10] = 5 * words(30)  # base rejects
        part = words(40)
        texts[i + 20] = words(10) + part + words(120) + part + words(10)  # the suffix array rejects
    texts[190] = words(6000)  # more than a window
    rows = [(i, " ".join(t) if i != 101 else " ".join(t).upper(), "en", ("a", "b", "c", None)[i % 4], 1) for i, t in texts.items()] + [(191, None, "en", "a", 1), (192, "", "en", "a", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")

    kept = {r[0]: r for r in rows if brute_force_quality(r[1])}
    assert not kept.keys() & set(range(160, 190)) and len(kept) == 161
    by_text = {}
    for i, r in sorted(kept.items()):
        by_text[r[1].lower()] = i
    kept = {i: kept[i] for i in by_text.values()}
    assert len(kept) == 141
    root = near_copy_groups({i: r[1] for i, r in kept.items()})
    kept = {i: kept[i] for i in set(root.values())}
    assert 101 < len(kept) < 141
    spark.createDataFrame(list(kept.values()), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/near.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/near.parquet/*.parquet')")
    copies = {i: taken // size for i, size, _, _, taken in con.execute(mixing.OP6_SQL).fetchall()}
    assert set(copies.values()) == {0, 1, 2}

    tok = tokens.encoder(tokens.vocabulary("byte_bpe_50k.json")).tokenizer
    ids = {i: [*tok.encode(r[1], add_special_tokens=False).ids, 1] for i, r in kept.items()}
    seen = {i: np.zeros(len(x), int) for i, x in ids.items()}
    sequences = collections.defaultdict(list)
    for r in cp.run(spark, str(tmp_path)).collect():
        own, at = ids[r["doc_id"]], slice(r["start"], r["start"] + r["length"])
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == crc(own[at])
        seen[r["doc_id"]][at] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all((n == copies[i]).all() for i, n in seen.items())
    full = []
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        full.append(at)
    assert max(full) <= 2048 and sum(n < 2048 for n in full) <= 1


def test_components_go_round_with_a_forest_of_the_edges(spark, monkeypatch):
    from scenequill.llm import components

    seen, stage = [], components.stage

    def counted(df, name):
        out = stage(df, name)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(components, "stage", counted)
    clique = [(i, j) for i in range(10, 70) for j in range(10, i)]
    edges = [*clique, *[(i, i + 1) for i in range(100, 120)], (7, 7), (300, 200), (200, 300)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 10 for i in range(11, 70)} | {i: 100 for i in range(101, 121)} | {300: 200}
    rounds = [n for name, n in seen if name == "stars"]
    before = seen[[name for name, _ in seen].index("stars") - 1][1]
    assert before == 59 + 20 + 1 and max(rounds) <= before


def test_near_dedup_makes_no_row_for_each_pair_of_a_large_group(spark, monkeypatch):
    seen, stage = {}, simhash.stage

    def counted(df, name):
        out = stage(df, name)
        seen[name] = seen.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(simhash, "stage", counted)
    rng = random.Random(9)
    base = [f"v{rng.randrange(5000)}" for _ in range(300)]
    texts = {i: " ".join(edited(base, 5, rng)) for i in range(200)}  # just not alike to one another
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.near_dedup(docs).collect()} == set(near_copy_groups(texts).values())
    print(seen)
    assert seen["table-simhash"] == 200 and sum(n for name, n in seen.items() if name.startswith(("near-within", "near-across", "near-more"))) < 200
