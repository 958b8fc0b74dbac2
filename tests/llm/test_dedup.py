"""Near duplicates, suffix arrays, decontamination: against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpreg.llm import decontam, near_dup, suffix_dedup
from corpreg.llm.textutil import SEGMENT, word_hashes

WORDS = [a + b for a in "ba ke li mo nu ra se ti wo zu".split() for b in "dak fen gil hop jur kam lot mir nes".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def documents(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + more)


def as_docs(spark, pairs):
    return documents(spark, [(i, t, "en", "s", len(t) if t is not None else None) for i, t in pairs])


def test_word_hashes_do_not_depend_on_neighbours():
    long = "x" * (SEGMENT + 5)
    one, at = word_hashes(["Alpha beta", None, "", "été ALPHA", f"a {long} b"])
    two, _ = word_hashes(["alpha, été"])
    assert at.tolist() == [0, 2, 2, 2, 4, 4 + len(one) - 4]
    assert one[0] == two[0] == one[3] and one[2] == two[1]


@pytest.mark.parametrize("seed", range(3))
def test_banded_alignment_equals_edit_distance(seed):
    rng = random.Random(seed)
    for _ in range(300):
        a = [rng.randint(0, 6) for _ in range(rng.randint(1, 25))]
        b = list(a)
        for _ in range(rng.randint(0, 7)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = [rng.randint(0, 6)] * rng.randint(0, 1)
        b = b or [1]
        d, x, y = edit_distance(a, b), np.array(a, np.uint64), np.array(b, np.uint64)
        assert (near_dup.banded_distance(x, y, 6) <= 6) == (d <= 6)
        assert near_dup.similar(x, y) == (d <= int(0.2 * max(len(a), len(b)) + 1e-9))


def test_near_duplicate_classes(spark):
    rng = random.Random(4)
    base = [prose(rng, 120) for _ in range(30)]
    rows = [(100 + i, t) for i, t in enumerate(base)]
    rows += [(200 + i, base[0]) for i in range(40)]  # a group of copies
    for i in range(60):  # near copies of one text, each with other edits
        words = base[1].split()
        for _ in range(5):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append((300 + i, " ".join(words)))
    inserted = base[2].split()
    inserted[60:60] = ["new", "words", "here"]
    rows += [(50, " ".join(inserted)), (400, None), (401, ""), (402, "..."), (403, "two words"), (404, "two words"), (100, base[0]), (None, base[3]), (405, "long " + "na " * 20000)]
    rng.shuffle(rows)
    found = near_dup.classes(as_docs(spark, rows)).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r["class_id"], []).append(r["doc_id"])
    assert sorted(by[100]) == [100, 100, *range(200, 240)]
    assert sorted(by[101]) == [101, *range(300, 360)]
    assert sorted(by[50]) == [50, 102] and sorted(by[103], key=str) == [103, None] and sorted(by[403]) == [403, 404]
    assert by[400] == [400] and by[401] == [401] and by[402] == [402]
    assert all(len(v) == 1 for k, v in by.items() if k not in (100, 101, 50, 103, 403))


def brute_classes(texts):
    """Smallest position of each text's class, by all pairs."""
    words = [word_hashes([t])[0] for t in texts]
    of = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if near_dup.similar(words[i], words[j]) and of[i] != of[j]:
                low, high = sorted((of[i], of[j]))
                of = [low if x == high else x for x in of]
    return of


def test_many_families_on_one_template(spark):
    rng = random.Random(12)
    template = [f"form{i}" for i in range(80)]
    texts = []
    for k in range(40):  # pairs are at 87/105, families at 80/105 at most
        own = [f"own{k}x{i}" for i in range(25)]
        other = [f"new{k}x{i}" if i < 18 else w for i, w in enumerate(own)]
        texts += [" ".join(template + own), " ".join(template + other)]
    texts += [" ".join(template[:40] + [rng.choice(WORDS) for _ in range(60)]) for _ in range(10)]
    want = brute_classes(texts)
    assert len(set(want)) == 50
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(as_docs(spark, list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_length_groups_hold_every_pair_of_near_lengths(spark):
    members = spark.createDataFrame([(b, f"{b}-{n}-{c}".encode(), n, f"{n if n > 25 else 0}-{c}".encode()) for b in (1, 2) for n in range(1, 61) for c in range(b)], "bucket long, key binary, words long, label binary")
    groups = near_dup.length_groups(members)
    assert groups.where("not few").isEmpty()
    got = [(bytes(r["a"]), bytes(r["b"])) for r in near_dup.pairs_within(groups).collect()]
    rows = [(r["bucket"], bytes(r["key"]), r["words"], bytes(r["label"])) for r in members.collect()]
    want = {tuple(sorted((x[1], y[1]))) for x in rows for y in rows if x[0] == y[0] and x[3] != y[3] and abs(x[2] - y[2]) <= int(0.2 * max(x[2], y[2]) + 1e-9)}
    assert len(got) == len(set(got)) and set(got) == want


def test_small_groups_are_met_without_grams(spark, monkeypatch):
    texts = [" ".join(f"form{i}" for i in range(50)) + " " + " ".join(f"own{k}x{i}" for i in range(20)) for k in range(12)]
    texts += [f"{t} more" for t in texts]
    want, sizes, across = brute_classes(texts), [], near_dup.pairs_across

    def counted(bodies, *rest, **more):
        sizes.append(bodies.count())
        return across(bodies, *rest, **more)

    monkeypatch.setattr(near_dup, "pairs_across", counted)
    for meets, used in ((32, []), (0, [24])):
        monkeypatch.setattr(near_dup, "MEETS", meets)
        sizes.clear()
        got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(as_docs(spark, list(enumerate(texts))), rounds=1).collect()}
        assert [got[i] for i in range(len(texts))] == want
        assert sizes == used


def test_recall_at_the_threshold(spark):
    rng = random.Random(14)
    texts = []
    for n in (10, 20, 100, 200):
        for similarity in (0.8, 0.85):
            for k in range(40):
                one = [f"w{rng.randrange(20000)}" for _ in range(n)]
                edits = int((1 - similarity) * n + 1e-9)
                at = rng.sample(range(n), edits) if k % 2 else [n // edits * i + n // edits // 2 for i in range(edits)]
                two = [f"x{rng.randrange(20000)}" if i in at else w for i, w in enumerate(one)]
                texts += [" ".join(one), " ".join(two)]
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(as_docs(spark, list(enumerate(texts)))).collect()}
    linked = np.array([got[i] == got[i + 1] for i in range(0, len(texts), 2)]).reshape(8, 40).mean(1)
    assert linked.min() >= 0.95 and linked.mean() >= 0.99 and linked[:2].min() == 1, linked
    assert len(set(got.values())) >= len(texts) // 2


def test_prefix_filter_and_samples_lose_no_similar_pair(spark):
    rng = random.Random(13)
    texts = []
    for n in [1, 2, 3, 4, 5, 6, 9, 10, 11, 14, 15, 20, 33, 60] * 6:
        words = [rng.choice(WORDS[:40]) for _ in range(n)]
        texts.append(" ".join(words))
        for _ in range(n // 5):  # scattered edits, as many as are allowed
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = [rng.choice(WORDS)] * rng.randint(0, 1)
        texts.append(" ".join(words) + "!")
    texts = list(dict.fromkeys(t for t in texts if word_hashes([t])[0].size))
    keys = [hashlib.md5(t.encode()).digest() for t in texts]
    hashes, begin = word_hashes(texts)
    bodies = spark.createDataFrame(list(zip(keys, texts, strict=True)), "key binary, text string")
    marks = spark.createDataFrame(list(zip(keys, np.diff(begin).tolist(), near_dup.gram_samples(texts), strict=True)), "key binary, words long, sample binary")
    found = {frozenset((bytes(r["a"]), bytes(r["b"]))) for r in near_dup.pairs_across(bodies, marks, bodies.select("key", F.col("key").alias("label"))).collect()}
    for i in range(len(texts)):
        for j in range(i):
            if near_dup.similar(hashes[begin[i] : begin[i + 1]], hashes[begin[j] : begin[j + 1]]):
                assert frozenset((keys[i], keys[j])) in found


def test_samples_rule_out_unlike_long_texts_only():
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(400)]
    for n in (130, 300, 1000, 5000):
        texts = []
        for k in range(30):
            one = [rng.choice(vocabulary) for _ in range(n)]
            two = list(one)
            for at in rng.sample(range(n), int(0.2 * n)) if k % 2 else range(0, n // 5):  # as many edits as are allowed, spread or in one place
                two[at] = f"x{rng.randrange(10**6)}"
            texts += [" ".join(one), " ".join(two)]
        samples = [np.frombuffer(x, np.uint32) for x in near_dup.gram_samples(texts)]
        assert all(near_dup.may_be_similar(samples[i], samples[i + 1], n, n) for i in range(0, 60, 2))
        unlike = [near_dup.may_be_similar(samples[i], samples[j], n, n) for i in range(0, 60, 2) for j in range(i + 2, 60, 2)]
        assert np.mean(unlike) < 0.01
    assert near_dup.gram_samples([]) == [] and near_dup.gram_samples(["", "one"])[0] == b""


def test_keep_one_keeps_a_row_of_each_class_and_all_columns(spark):
    rng = random.Random(5)
    a, b = prose(rng, 50), prose(rng, 50)
    rows = [(3, a, 1), (1, a, 2), (1, a, 3), (None, a, 4), (7, b, 5), (8, None, 6), (9, None, 7), (None, None, 8)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, k, "x") for i, t, k in rows], "doc_id long, text string, lang string, source string, n_chars long, key int, copies string")
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in kept.collect())
    assert got == sorted([(1, a), (7, b), (8, ""), (9, ""), (-1, "")])
    empty = near_dup.keep_one(docs.where("false"))
    assert empty.collect() == [] and empty.columns == docs.columns


def brute_cut(rows):
    """The contract, word for word."""
    order = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            s = raw[p : p + 50]
            order[s] = min(order.get(s, suffix_dedup.LAST), i if i is not None else suffix_dedup.LAST)
    out = []
    for i, t in rows:
        raw, gone = (t or "").encode(), set()
        for p in range(len(raw) - 49):
            if order[raw[p : p + 50]] < (i if i is not None else suffix_dedup.LAST):
                gone.update(range(p, p + 50))
        runs = sum(1 for p in gone if p - 1 not in gone)
        out.append((i, len(raw), len(gone), runs, hashlib.sha256(bytes(c for p, c in enumerate(raw) if p not in gone)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("kinds", [1, 2, 4, 26])
def test_suffix_array_order(kinds):
    rng = random.Random(kinds)
    for n in (1, 2, 60, 500):
        data = np.array([97 + rng.randrange(kinds) for _ in range(n)], np.uint8)
        raw, order = data.tobytes(), suffix_dedup.suffix_array(data)
        assert sorted(order.tolist()) == list(range(n))
        depth = 8 * suffix_dedup._DEPTH
        assert all(raw[x : x + depth] <= raw[y : y + depth] for x, y in zip(order, order[1:], strict=False))
        for x, y, v in zip(order, order[1:], suffix_dedup.adjacent_prefixes(data, order), strict=False):
            same = next((m for m in range(n) if raw[x + m : x + m + 1] != raw[y + m : y + m + 1] or x + m >= n or y + m >= n), n)
            assert min(same, depth) == v


def overlapping_rows():
    rng = random.Random(6)
    passages = [prose(rng, 14) for _ in range(5)] + ["é" * 30, "ab" * 40, "z" * 49]
    rows = []
    for i in range(120):
        parts = [prose(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng, rng.randint(0, 9))]
        rows.append((rng.randint(0, 80), " ".join(parts)))
    rows += rows[:10] + [(None, rows[0][1]), (None, passages[0] * 2), (500, None), (501, ""), (502, "short"), (2, "q" * 300), (503, "q" * 170)]
    return rows


def test_suffix_dedup_equals_brute_force(spark):
    rows = overlapping_rows()
    got = sorted((tuple(r) for r in suffix_dedup.report(as_docs(spark, rows).repartition(5)).collect()), key=str)
    assert got == brute_cut(rows)


def test_suffix_dedup_with_hot_anchors_and_small_groups(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    monkeypatch.setattr(suffix_dedup, "CONTEXT_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "ANCHORS_PER_BUCKET", 100)
    rows = overlapping_rows()
    got = sorted((tuple(r) for r in suffix_dedup.report(as_docs(spark, rows).repartition(4)).collect()), key=str)
    assert got == brute_cut(rows)


def test_suffix_dedup_keeps_columns_and_drops_what_is_empty(spark):
    rng = random.Random(8)
    a, b = prose(rng, 30), prose(rng, 30)
    docs = spark.createDataFrame([(1, a, 1, 9), (2, a, 2, 9), (3, f"{a} {b}", 3, 9), (4, None, 4, 9), (5, "", 5, 9)], "doc_id long, text string, kept int, n_chars long")
    got = {r["doc_id"]: r for r in suffix_dedup.deduplicate(docs).collect()}
    assert suffix_dedup.deduplicate(docs).columns == docs.columns
    assert sorted(got) == [1, 3, 4, 5] and got[1]["text"] == a and got[1]["n_chars"] == 9
    assert got[3]["text"] == f" {b}" and got[3]["n_chars"] == len(b) + 1 and got[4]["text"] is None
    assert suffix_dedup.report(docs.where("false")).collect() == []


def brute_matches(docs, items):
    def shingles(words):
        k = min(5, len(words))
        found = {}
        for p in range(len(words) - k + 1):
            s = tuple(words[p : p + k])
            found[s] = found.get(s, 0) + 1
        return k, found

    out = set()
    for i, text in docs:
        words = (text or "").lower().replace(",", " ").replace(".", " ").split()
        for j, item in items:
            own = (item or "").lower().replace(",", " ").replace(".", " ").split()
            if not own:
                continue
            k, wanted = shingles(own)
            n, best = min(len(own), len(words)), None
            for p in range(len(words) - n + 1) if n >= k else []:
                have = {}
                for q in range(p, p + n - k + 1):
                    s = tuple(words[q : q + k])
                    have[s] = have.get(s, 0) + 1
                shared = sum(min(c, have.get(s, 0)) for s, c in wanted.items())
                x = shared / (sum(wanted.values()) + sum(have.values()) - shared)
                if x >= 0.8 and (best is None or x > best[2]):
                    best = (p, n, x)
            if best:
                out.add((i, j, *best))
    return out


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(9)
    items = [(k, prose(rng, rng.choice([12, 20, 30, 45]))) for k in range(25)] + [(90, "dak fen gil"), (91, None), (92, " . "), (None, prose(rng, 15)), (93, prose(rng, 25))]
    items.append((94, items[0][1]))
    docs = [(i, prose(rng, rng.randint(0, 150))) for i in range(60)]
    for i in range(60, 120):
        words = rng.choice([t for _, t in items if t]).split()
        if rng.random() < 0.5 and len(words) > 10:
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        docs.append((i, f"{prose(rng, rng.randint(0, 60))} {' '.join(words).upper()}, {prose(rng, rng.randint(0, 60))}"))
    docs += [(None, items[1][1]), (200, None), (201, ""), (202, " ".join(items[2][1].split()[:-1])), docs[70], (203, items[3][1] + " " + prose(rng, 30000))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontam.contaminated(as_docs(spark, docs), bench).collect()}
    assert {(a, b, c, d, round(e, 9)) for a, b, c, d, e in got} == {(a, b, c, d, round(e, 9)) for a, b, c, d, e in brute_matches(docs, items)}
    again = {tuple(r) for r in decontam.contaminated(as_docs(spark, docs), bench, items_per_pass=7).collect()}
    assert again == got
    kept = decontam.clean(as_docs(spark, docs).withColumn("item", F.lit(1)), bench)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _ in docs if not any(m[0] == i for m in got))
    assert decontam.contaminated(as_docs(spark, docs), bench.where("false")).collect() == []


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    asked = prints ^ np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 30), replace=False)) for _ in prints], np.uint64)
    query, item = decontam.MultiIndex(prints).near(asked)
    want = np.argwhere(np.bitwise_count(asked[:, None] ^ prints[None]) <= decontam.RADIUS)
    assert sorted(zip(query.tolist(), item.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))
