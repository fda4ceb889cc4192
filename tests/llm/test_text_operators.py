"""Operators on documents against brute force, and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shoplens.llm import line_dedup, mixing, packing, quality_rules, simhash, substring_dedup
from shoplens.llm.perfect_hash import PerfectHash

SPACES = r"[^\x20\x09-\x0D]+"


def pairs_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def none_last(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


# --- mixing

def poisson_count(unit, mean):
    k, p = 0, np.exp(-mean)
    below = p
    while below < unit:
        k += 1
        p *= mean / k
        below += p
    return k


def test_mixing_replicates_by_the_inverse_poisson(odd_docs):
    rates = odd_docs.sparkSession.createDataFrame([("s1", 2.5), ("s2", 0.0), ("s3", 30.0), ("s4", 0.4), (None, 1.5)], "source string, rate double")
    got = Counter(r["text"] for r in mixing.replicate(odd_docs, rates, seed=3).select("text", "copy").collect())
    expected = Counter()
    by_source = dict(rates.collect())
    for r in odd_docs.select("doc_id", "text", "source").collect():
        key = "3" if r["doc_id"] is None else f"3|{r['doc_id']}"
        unit = (int(hashlib.md5(key.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        expected[r["text"]] += poisson_count(unit, by_source[r["source"]])
    assert got == +expected


def test_mixing_reaches_shares_and_keeps_columns(documents, odd_docs, no_docs):
    weights = {f"src{i}": float(i + 1) for i in range(5)}
    mixed = mixing.mix(documents, weights, epochs=20.0)
    assert set(documents.columns) < set(mixed.columns)
    sizes = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert set(sizes) <= set(weights)
    total = sum(sizes.values())
    for source, weight in weights.items():
        assert sizes[source] / total == pytest.approx(weight / 15, abs=0.06)
    keys = [r["shuffle_key"] for r in mixed.select("shuffle_key").collect()]
    assert keys == sorted(keys)
    assert mixing.mix(odd_docs).columns.count("copy") == 1 and mixing.mix(no_docs).count() == 0
    assert pairs_of(mixing.mix(documents), "doc_id", "copy") == pairs_of(mixing.mix(documents.repartition(5)), "doc_id", "copy")


# --- lines

def brute_lines(rows, shortest=20, least=3):
    strip = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(lower)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= shortest:
                holders[key(line)].add(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < least or max(holders[key(x)]) == (-1 if doc is None else doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return none_last(out)


@pytest.mark.parametrize("group_bytes", [64 << 20, 1])
def test_lines_equal_brute_force_in_one_and_many_groups(documents, odd_docs, group_bytes):
    extra = odd_docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text").unionByName(odd_docs.select("doc_id", "text"))
    docs = documents.select("doc_id", "text").unionByName(extra)
    got = line_dedup.dedup_lines(docs, shards=3 if group_bytes == 1 else None, group_bytes=group_bytes)
    rows = none_last([tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()])
    assert rows == brute_lines([tuple(r) for r in docs.collect()])
    assert sum(r[2] for r in rows) > 0


def test_lines_keep_columns_and_take_empty_tables(odd_docs, no_docs):
    got = line_dedup.dedup_lines(odd_docs)
    assert got.count() == odd_docs.count() and sorted(got.columns) == sorted(odd_docs.columns)
    assert line_dedup.dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize("group_bytes", [64 << 20, 100])
def test_a_line_in_a_third_of_all_rows_is_dropped_in_parts(documents, group_bytes):
    line = "a line that very many documents hold"
    rows = [(i, "\n".join([line if i % 3 == 0 else f"line number {i} of one document only", f"tail {i}"])) for i in range(600)]
    rows += [(3, rows[3][1])] * 5 + [(None, rows[0][1]), (None, None), (7, "")]
    docs = documents.sparkSession.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    got = line_dedup.dedup_lines(docs, shards=2, group_bytes=group_bytes)
    found = none_last([tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()])
    assert found == brute_lines(rows) and [r[0] for r in found if r[1] == 2 and line in r[3]] == [597]


def test_line_probes_pass_no_array_through_the_driver(odd_docs, monkeypatch):
    def refused(*_):
        raise AssertionError("rows were collected")

    monkeypatch.setattr(type(odd_docs), "collect", refused)
    plan = line_dedup.dedup_lines(odd_docs)
    monkeypatch.undo()
    assert plan.count() == odd_docs.count()


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n, dtype="uint64"))
    built = PerfectHash.build(keys)
    again, taken = PerfectHash.from_bytes(built.to_bytes() + b"tail")
    assert taken == len(built.to_bytes())
    assert sorted(again.index(keys).tolist()) == list(range(len(keys)))
    strangers = again.index(keys + np.uint64(1) if n else np.array([5], "uint64"))
    assert strangers.max(initial=-1) < max(1, len(keys))


def test_lines_that_agree_in_half_of_their_hash_are_told_apart():
    entries = np.array([(7, low, doc) for low in (1, 2, 3) for doc in (10, 20, 30)][:-1], line_dedup.ENTRY)
    n, data = line_dedup.build_shard(entries, 3)
    many, keeper = line_dedup.Shard(data, 3).keeper(np.array([7] * 4, "uint64"), np.array([1, 2, 3, 4], "uint64"))
    assert n == 3 and many.tolist() == [True, True, False, False] and keeper[:2].tolist() == [30, 30]


# --- SimHash

def brute_fingerprint(text, shingle):
    words = re.findall(SPACES, "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, ids, radius):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(ids)):
        members[find(i)].append(ids[i])
    return [min((x for x in members[find(i)] if x is not None), default=None) for i in range(len(ids))]


@pytest.mark.parametrize("shingle, radius", [(4, 4), (5, 3)])
def test_classes_equal_brute_force(documents, odd_docs, shingle, radius):
    docs = documents.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    rows = docs.collect()
    prints = [brute_fingerprint(r["text"], shingle) for r in rows]
    expected = [(r["doc_id"], p - (1 << 64) if p >> 63 else p, c) for r, p, c in zip(rows, prints, brute_classes(prints, [r["doc_id"] for r in rows], radius), strict=True)]
    got = simhash.near_duplicates(docs, shingle, radius).select("doc_id", "fingerprint", "component_id").collect()
    assert none_last([tuple(r) for r in got]) == none_last(expected)


@pytest.mark.parametrize("radius", [2, 4])
def test_links_connect_chains_and_dense_groups(spark, radius):
    rng = np.random.default_rng(radius)
    values = {int(x) for x in rng.integers(0, 2**63, 200)}
    for center in list(values)[:3]:  # dense: every neighbour at one or two bits
        values |= {center ^ (1 << i) ^ (1 << j) for i in range(0, 62, 3) for j in range(0, 62, 5)}
    chain = int(rng.integers(0, 2**63))
    for _ in range(30):
        values.add(chain)
        for b in rng.choice(63, radius, replace=False):
            chain ^= 1 << int(b)
    values = sorted(values)
    nodes = spark.createDataFrame([(k, v) for v in values for k in (0, 5)], "print int, fingerprint bigint")
    near = simhash.links(nodes, radius, 2 * len(values))
    expected = brute_classes(values, values, radius)
    for k in (0, 5):
        found = {r["node"]: r["root"] for r in simhash.components(near.where(F.col("print") == k)).collect()}
        assert [found.get(v, v) for v in values] == expected


def test_one_document_of_each_class_stays(odd_docs, no_docs, documents):
    # Linked by brute force: near in any of four fingerprints, and alike in their full sets of shingles.
    rows = sorted((r["doc_id"], r["text"] or "") for r in documents.collect())
    words = [t.lower().split() for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    prints = [simhash.majorities(t.encode(), 5, 4) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            alike = len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            if root[i] != root[j] and alike and np.bitwise_count(prints[i] ^ prints[j]).min() <= 6:
                root = [root[j] if x == root[i] else x for x in root]
    kept = simhash.one_per_class(documents)
    expected = {min(rows[k][0] for k, x in enumerate(root) if x == r) for r in set(root)}
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(expected)
    odd = simhash.one_per_class(odd_docs)
    assert odd.columns == odd_docs.columns
    assert Counter(r[0] for r in odd.select("doc_id").collect())[1] == 2  # two texts under one id are two classes
    assert simhash.one_per_class(no_docs).count() == 0


def test_several_prints_link_what_any_of_them_links(documents):
    rows = documents.select("doc_id", "text").collect()
    ids = [r["doc_id"] for r in rows]
    prints = [simhash.majorities((r["text"] or "").encode(), 5, 3) for r in rows]
    assert [int(p[0]) for p in prints] == [brute_fingerprint(r["text"], 5) for r in rows]
    near = lambda i, j: np.bitwise_count(prints[i] ^ prints[j]).min() <= 6
    root = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if root[i] != root[j] and near(i, j):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    least = {r: min(i for i, x in zip(ids, root, strict=True) if x == r) for r in set(root)}
    got = dict(simhash.near_duplicates(documents, 5, 6, 3).select("doc_id", "component_id").collect())
    assert got == {i: least[r] for i, r in zip(ids, root, strict=True)}


def test_edited_copies_lose_to_their_original(spark):
    rng, words, rows = np.random.default_rng(3), [f"w{i}" for i in range(5000)], []
    for i in range(60):
        text = rng.choice(words, 400).tolist()
        rows.append((i, " ".join(text)))
        for at in rng.choice(400, 4, replace=False):  # about 20 of 396 shingles: similarity 0.9
            text[at] = "edited"
        rows.append((1000 + i, " ".join(text)))
    kept = {r[0] for r in simhash.one_per_class(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id").collect()}
    assert set(range(60)) <= kept and len(kept) <= 66


def test_no_similar_pair_is_lost_that_fingerprints_miss(spark):
    rng, words, rows = np.random.default_rng(8), [f"w{i}" for i in range(5000)], []
    for i in range(60):
        text = rng.choice(words, 400).tolist()
        rows.append((i, " ".join(text)))
        for at in range(20, 380, 45):  # 8 edits, 40 of 396 shingles: similarity 0.817
            text[at] = "edited"
        rows.append((1000 + i, " ".join(text)))
    prints = [simhash.majorities(t.encode(), 5, 4) for _, t in rows]
    missed = [i for i in range(60) if np.bitwise_count(prints[2 * i] ^ prints[2 * i + 1]).min() > 6]
    assert len(missed) > 10
    kept = simhash.one_per_class(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == list(range(60))


def test_a_link_stays_when_both_ends_have_nearer_partners(spark):
    low = (1 << 20) | (1 << 30)
    high = low ^ 0b111111  # six bits apart; the four others are near their own center only
    values = [low, low ^ (1 << 20), low ^ (1 << 21), high, high ^ (1 << 30), high ^ (1 << 31)]
    far = [int(x) for x in np.random.default_rng(1).integers(0, 2**63, len(values))]
    nodes = spark.createDataFrame([(i, [v, f]) for i, (v, f) in enumerate(zip(values, far, strict=True))], "node bigint, prints array<bigint>")
    assert {tuple(r) for r in simhash.components(simhash._edges(nodes, 6)).collect()} == {(i, 0) for i in range(6)}


def test_equal_fingerprints_do_not_merge_unlike_texts(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(["same"] * 600 + words[200 * i : 200 * i + 200])) for i in range(2)]
    prints = [simhash.majorities(t.encode(), 5, 4) for _, t in rows]
    assert (prints[0] == prints[1]).all()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r[0] for r in simhash.one_per_class(docs).select("doc_id").collect()) == [0, 1]


# --- substrings

def brute_substrings(rows, width):
    split = [re.findall(SPACES, t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return none_last(out)


@pytest.mark.parametrize("width", [3, 35])
def test_substrings_equal_brute_force(documents, odd_docs, width, monkeypatch):
    short = odd_docs.where("length(text) < 50000 or text is null").select("doc_id", "text")
    loops = odd_docs.sparkSession.createDataFrame([(900 + i, " ".join(["p q"] * n)) for i, n in enumerate((1, 17, 18, 40, 300))], "doc_id bigint, text string")
    docs = documents.select("doc_id", "text").unionByName(short).unionByName(loops)
    expected = brute_substrings([tuple(r) for r in docs.collect()], width)
    for hot in (20_000, 2):  # with 2 nearly every repeated minimiser counts as hot
        monkeypatch.setattr(substring_dedup, "HOT", hot)
        got = substring_dedup.dedup_substrings(docs, width).select("doc_id", "n_words", "n_removed", "text").collect()
        assert none_last([tuple(r) for r in got]) == expected


def test_substrings_take_long_texts_and_empty_tables(odd_docs, no_docs):
    got = substring_dedup.dedup_substrings(odd_docs)
    rows = {r["doc_id"]: r for r in got.where("doc_id in (4, 5)").select("doc_id", "n_words", "n_removed").collect()}
    assert rows[4]["n_removed"] == 60_000 and rows[5]["n_words"] - rows[5]["n_removed"] == 1
    assert got.count() == odd_docs.count() and sorted(got.columns) == sorted(odd_docs.columns)
    assert substring_dedup.dedup_substrings(no_docs).count() == 0


# --- packing

@pytest.mark.parametrize("text", [
    "it's THE Don'T x'll 12a3 <|endoftext|> a<|startoftext|>b", "", "  ", "étude ½ µm ªº «Ünï» × ÷ ÿ Ÿ \x85z ﬁ Σας İstanbul",
    "日本語テスト 🙂 näive \x1c a\x1fb don't've 'S é e ́", "A" * 3000,
])
def test_encoder_equals_the_tokenizer(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = np.frombuffer(next(packing.encoder(path)([text.encode()])), "<u4").tolist()
    assert got == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_every_id_lies_in_one_piece_and_windows_hold(documents, odd_docs, no_docs):
    docs = documents.select("doc_id", "text").unionByName(odd_docs.where("doc_id > 1").select((F.col("doc_id") + 5000).alias("doc_id"), "text"))
    packed = packing.pack(docs, keep_ids=True).cache()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = {r["doc_id"]: np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4") for r in docs.collect()}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    for doc, ids in wanted.items():
        own = sorted(pieces[doc], key=lambda r: r["start"])
        assert [r["start"] for r in own] == np.cumsum([0, *[r["length"] for r in own]])[:-1].tolist()
        assert b"".join(bytes(r["ids"]) for r in own) == ids.tobytes() and {r["doc_tokens"] for r in own} == {len(ids)}
        assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in own)
    padding = 0
    for rows in windows.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == np.cumsum([0, *[r["length"] for r in rows]])[:-1].tolist()
        n = sum(r["length"] for r in rows)
        assert n <= 2048
        padding += 2048 - n if n & (n - 1) else 0
    assert padding < 0.03 * sum(map(len, wanted.values()))
    for r in packing.sequences(packed).collect():
        ids = b"".join(bytes(p["ids"]) for p in windows[r["sequence_id"]])
        n = r["n_tokens"]
        assert bytes(r["ids"]) == (ids if n & (n - 1) == 0 else ids.ljust(4 * 2048, b"\0"))
    assert packing.pack(no_docs).count() == 0 and packing.pack(odd_docs).where("doc_id is null").count() == 2


@pytest.mark.parametrize("sizes, k", [([8, 7, 6, 5, 4], 2), ([5, 5, 5, 5], 4), ([9], 3), ([], 1), ([1] * 20, 3)])
def test_differencing_covers_every_index_once(sizes, k):
    sets = packing.differencing(sizes, k)
    assert sorted(i for s in sets for i in s) == list(range(len(sizes))) and len(sets) <= k
    if sizes == [8, 7, 6, 5, 4]:  # the textbook case: sums 16 and 14
        assert sorted(sum(sizes[i] for i in s) for s in sets) == [14, 16]


def test_window_count_rises_with_the_capacity():
    sets = packing.windows_of([1500, 1500, 1500], 2048)
    assert len(sets) == 3


# --- quality rules

def brute_counts(text):
    text = text or ""
    words = re.findall(SPACES, text)
    lines = [x for x in text.split("\n") if re.search(SPACES, x)]
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_counts_equal_brute_force(documents, odd_docs, no_docs):
    docs = documents.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    loops = odd_docs.sparkSession.createDataFrame([(800 + i, "a b a b a b c\na b\na b\n" * i) for i in range(4)], "doc_id bigint, text string")
    docs = docs.unionByName(loops)
    got = quality_rules.signals(docs).select("doc_id", *quality_rules.COUNTS).collect()
    expected = [(r["doc_id"], *brute_counts(r["text"])) for r in docs.collect()]
    assert none_last([tuple(r) for r in got]) == none_last(expected)
    assert quality_rules.weak_supervision(no_docs).count() == 0


def test_rates_are_found_and_posteriors_decide():
    rng = np.random.default_rng(4)
    # Per rule: good and bad votes on good text, good and bad votes on bad text.
    true, n = [(0.7, 0.05, 0.1, 0.8), (0.8, 0.1, 0.2, 0.6), (0.0, 0.02, 0.0, 0.6), (0.9, 0.02, 0.05, 0.9), (0.5, 0.1, 0.1, 0.5)], 40_000
    good = rng.random(n) < 0.8
    votes = np.zeros((n, len(true)), int)
    for k, (g1, g0, b1, b0) in enumerate(true):
        u, up, down = rng.random(n), np.where(good, g1, b1), np.where(good, g0, b0)
        votes[:, k] = np.where(u < up, 1, np.where(u < up + down, -1, 0))
    prior, rates = quality_rules.fit_rates(Counter(map(tuple, votes.tolist())), len(true))
    assert prior == pytest.approx(0.8, abs=0.02)
    found = np.array([(r[1][0], r[-1][0], r[1][1], r[-1][1]) for r in rates])
    assert np.abs(found - np.array(true)).max() < 0.05
    right, wrong = quality_rules.accuracy_of(rates[3])
    assert right == pytest.approx(0.9 / 0.92, abs=0.02) and wrong == pytest.approx(0.9 / 0.95, abs=0.02)
    judged = np.array([quality_rules.posterior(tuple(v), prior, rates) for v in votes[:4000].tolist()]) >= 0.5
    assert (judged == good[:4000]).mean() > 0.95
    assert quality_rules.fit_rates({}, 2)[0] == 0.8


def test_kept_documents_follow_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality_rules.weak_supervision(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = judged.where("not base_failed").drop("quality").join(labels, "doc_id").select("kept", "quality").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.5
