import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import packing
from quire.llm.registry import op10_packing


def brute(lengths, capacities):
    """The same rules by a search of all open bins for every item."""
    room, used, bins = [], [], []
    left = sum(lengths)
    for n in lengths:
        fits = [(r, -age) for age, r in enumerate(room) if r >= n]
        if fits:
            least = min(r for r, _ in fits)
            b = max((b for b, r in enumerate(room) if r == least), key=lambda b: touched[b])
        else:
            size = min((c for c in sorted(capacities) if c >= n), key=lambda c: (packing.cost(c) / min(c, left), c))
            b = len(room)
            room.append(size)
            used.append(0)
            if not b:
                touched = {}
        touched[b] = len(bins)
        bins.append(b)
        room[b] -= n
        used[b] += n
        left -= n
    return bins, [min(c for c in capacities if c >= u) for u in used]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_bins_equal_the_plain_search(lengths):
    lengths.sort(reverse=True)
    bins, _, caps = packing.pack(lengths, (16, 32, 64))
    assert (bins, caps) == (brute(lengths, (16, 32, 64)) if lengths else ([], []))


def test_several_sizes_cost_no_more_than_one():
    random.seed(1)
    lengths = sorted((min(4096, int(random.lognormvariate(5.5, 1.2)) + 1) for _ in range(4000)), reverse=True)
    total = {caps: sum(map(packing.cost, packing.pack(lengths, caps)[2])) for caps in ((4096,), packing.CAPACITIES)}
    assert total[packing.CAPACITIES] <= total[(4096,)]
    caps = packing.pack(lengths)[2]
    assert sum(lengths) / sum(caps) > 0.97


def check_layout(rows, lengths):
    """Every token of every item is placed once; bins are dense and tight."""
    seqs, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.seq_id].append(r)
        pieces[r.doc_id].append((r.first_token, r.n_tokens))
    for doc, n in lengths.items():
        at = 0
        for first, size in sorted(pieces.pop(doc)):
            assert first == at
            at += size
        assert at == n
    assert not pieces
    for members in seqs.values():
        at = 0
        for r in sorted(members, key=lambda r: r.position):
            assert r.position == at
            at += r.n_tokens
        caps = {r.capacity for r in members}
        assert caps == {min(c for c in packing.CAPACITIES if c >= at)}


def test_query_places_every_token(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check_layout(op10_packing(spark, sf).collect(), {d: len((t or "").encode().split()) + 1 for d, t in texts.items()})


def test_nulls_repeats_long_texts_and_empty_tables(spark, tmp_path):
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "x y z"), (4, "w " * 20_000)]
    df = spark.createDataFrame([(d, t, 3) for d, t in rows], "doc_id long, text string, capacity int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = op10_packing(spark, str(tmp_path)).collect()
    assert sorted((r.n_tokens for r in got), reverse=True) == [4096] * 4 + [3617, 4, 3, 3, 1, 1]
    seqs = packing.sequences(spark.createDataFrame(got)).collect()
    assert sum(r.used for r in seqs) == sum(r.n_tokens for r in got) and all(r.used <= r.capacity for r in seqs)
    df.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert op10_packing(spark, f"{tmp_path}/empty").count() == 0
