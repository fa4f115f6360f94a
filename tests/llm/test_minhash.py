import random
import re
from collections import defaultdict

import numpy as np

from quire.llm import minhash
from quire.llm.registry import op8_near_duplicates


def brute(rows, words=4, percent=80):
    """Sets of word tuples, an inverted index over them, and union-find."""
    sets = {}
    for i, (doc, text) in enumerate(rows):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        k = min(words, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    common = defaultdict(int)
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                common[ids[b], ids[a]] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((doc, len(sets[i]), least[root(i)], doc == least[root(i)]) for i, (doc, _) in enumerate(rows))


def run(spark, path, rows):
    df = spark.createDataFrame([(d, t, True) for d, t in rows], "doc_id long, text string, kept boolean")
    df.repartition(3).write.parquet(f"{path}/documents.parquet")
    return sorted(tuple(r) for r in op8_near_duplicates(spark, str(path)).collect())


def test_chains_hot_groups_and_odd_texts(spark, tmp_path):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n * 3 + 5, text))
        n += 1

    for _ in range(60):
        add(" ".join(random.choices(vocabulary, k=random.randint(1, 80))))
    chain = random.choices(vocabulary, k=120)
    for step in range(12):  # each link holds, the ends are far apart
        at = 10 * step % 110
        chain = chain[:at] + random.choices(vocabulary, k=2) + chain[at + 2:]
        add(" ".join(chain))
    base = random.choices(vocabulary, k=200)
    for _ in range(120):
        one = list(base)
        one[random.randrange(200)] = "zz"
        add("  ".join(one).upper())
    for _ in range(50):
        add(" ".join(base))
    passage = " ".join(random.choices(vocabulary, k=40))
    for _ in range(60):
        add(passage + " " + " ".join(random.choices(vocabulary, k=50)))
    for text in (None, "", " \n\t", "one", "One", "one two", "ÉÉ éé x y z", "a b c d", "a b c d e", "é " * 5000, "long " * 30_000):
        add(text)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_all_rows_of_the_table(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in op8_near_duplicates(spark, sf).collect()) == brute(rows)


def test_missing_ids_repeats_and_empty_tables(spark, tmp_path):
    text = "a b c d e f g h i j"
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "a b c d e f g h i j"), (3, None)],
                               "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 6, 1, True), (1, 6, 1, True), (None, 6, None, False), (2, 6, 1, False), (3, 0, 3, True)], key=str)
    assert sorted([r.doc_id for r in minhash.keep_one(df).collect()], key=str) == [1, 3, None]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000), (2000, 1500)]
    got = dict(map(tuple, minhash.components(spark.createDataFrame(edges, "x long, y long")).collect()))
    assert {got[i] for i in range(301)} == {0} and got[1500] == 1000 and len(got) == 304


def test_rows_of_one_id_with_different_texts_all_stay(spark):
    texts = ["alpha beta gamma delta epsilon zeta", "one two three four five six", "", None]
    df = spark.createDataFrame([(7, t, "x") for t in texts] + [(7, texts[0].upper(), "y"), (2, texts[1], "z")],
                               "doc_id long, text string, lang string")
    got = sorted(((r.doc_id, r.text) for r in minhash.keep_one(df).collect()), key=str)
    assert [x for x in got if not (x[1] or "").lower().startswith("alpha")] == sorted(
        [(2, texts[1]), (7, ""), (7, None)], key=str)
    assert len(got) == 4 and minhash.keep_one(df).columns == df.columns


def test_prefixes_leave_out_what_one_component_has(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words[:20])), (2, " ".join(words[:19] + ["x"])), (3, " ".join(words[5:35])), (4, " ".join(words[30:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    open_ = spark.createDataFrame([(d, d, len(minhash.shingle_set(t, 1))) for d, t in rows], "v long, c long, n long")
    got = {r.v: len(r.prefix) for r in minhash.prefixes(open_, docs, 1, 80).collect()}
    # 1 and 2 have a prefix of 5 of 20 shingles, of which 0 and 1 are their own; 3 has 7 of
    # 30 and 4 has 3 of 10, all their own (10 and 5 are).
    assert got == {1: 5, 2: 4}


def test_tiles_find_every_link_of_a_hot_shingle(spark):
    rng = np.random.default_rng(2)
    base = np.arange(100)
    rows, sets = [], {}
    for v in range(3 * minhash.TILE):  # variants of one text, some of which are similar
        s = np.sort(np.append(rng.permutation(base)[:rng.integers(88, 97)], rng.integers(100, 130, 3)))
        sets[v] = set(s.tolist())
        rows.append((1, len(rows), v, v // 2, len(sets[v]), sorted(sets[v])))
    df = spark.createDataFrame(rows, "key long, i long, v long, c long, n long, common array<long>").drop("i").withColumn(
        "size", minhash.F.lit(len(rows)))
    want = {(a, b) for a in sets for b in range(a) if a // 2 != b // 2 and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    got = [tuple(sorted(r, reverse=True)) for r in minhash.tiled_links(df, 85).collect()]
    assert 0 < len(want) < len(rows) ** 2 / 3 and set(got) == want and len(got) == len(want)


def test_intersections_in_several_steps(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(-50, 50, rng.integers(0, 40))) for _ in range(20)]
    want = [[len(set(a) & set(b)) for b in sets] for a in sets]
    for columns in (1, 7, 1 << 14):
        monkeypatch.setattr(minhash, "COLUMNS", columns)
        got = minhash.intersections(sets)
        assert all(got[i, j] == want[i][j] for i in range(20) for j in range(20) if i != j)


def test_large_ids_beside_null_ids_and_no_sets_left_on_disk(spark):
    """Ids beyond 2**53 stay exact where other rows have none, and the staged sets go when
    their pairs are confirmed."""
    from pathlib import Path

    from quire.llm.common import shared_dir

    big = (1 << 53) + 1
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(big, text), (big + 1, text + " more"), (None, text), (7, None), (8, "  "), (9, "a b")]
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("stage-sets-*"))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), words=4).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {
        (big, big, True), (big + 1, big, False), (None, None, False), (7, 7, True), (8, 8, True), (9, 9, True)}
    assert {r.doc_id: r.n_shingles for r in got if r.doc_id} == {big: 57, big + 1: 58, 7: 0, 8: 0, 9: 1}
    assert set(folder.glob("stage-sets-*")) == before
