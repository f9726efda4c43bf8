import random
import sys
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barloom.llm.lengths import length_histogram, limit_table, merge_histograms, quantile_length, totals_at  # noqa: E402
from barloom.llm.packing import CAPACITIES, OVERHEAD, best_fit, pack  # noqa: E402
from barloom.llm.queries import op6_best_fit_packing, op10_token_counts  # noqa: E402
from barloom.llm.tokens import encoder, token_count  # noqa: E402
from plain import SF, table  # noqa: E402


def bins_of(lengths, placed):
    bins = defaultdict(list)
    for n, (b, at, capacity) in zip(lengths, placed, strict=True):
        bins[b].append((at, n, capacity))
    return bins


def test_best_fit():
    rng = random.Random(1)
    for sizes in ((512, 1024, 2048, 4096), (7,), (3, 10)):
        lengths = [rng.randrange(1, max(sizes) + 1) for _ in range(700)] + [max(sizes)] * 3
        for pieces in bins_of(lengths, best_fit(lengths, sizes, 16)).values():
            pieces.sort()
            end = 0
            for at, n, _ in pieces:  # end to end, nothing between
                assert at == end
                end += n
            assert {c for _, _, c in pieces} == {min(c for c in sizes if c >= end)}
    assert best_fit([], (5,), 1) == []


def test_sizes_are_chosen_by_cost():
    # Alone, a short piece takes the smallest size; among many, pieces that fill a size exactly take that.
    assert best_fit([100], (512, 1024), 16)[0][2] == 512
    exact = bins_of([512] * 8, best_fit([512] * 8, (512, 4096), 16))
    assert len(exact) == 1 and exact[0][0][2] == 4096
    cost = lambda lengths, sizes: sum(p[0][2] + OVERHEAD for p in bins_of(lengths, best_fit(lengths, sizes, OVERHEAD)).values())
    rng = random.Random(6)
    lengths = [min(4096, int(rng.lognormvariate(6, 1)) + 1) for _ in range(3000)]
    assert cost(lengths, CAPACITIES) < 1.02 * (sum(lengths) + OVERHEAD * sum(lengths) / max(CAPACITIES))


def test_every_token_is_packed_once(spark):
    rng = random.Random(9)
    rows = [(i, rng.randrange(0, 12_000)) for i in range(300)] + [(5, 100), (None, 4096), (None, 4097), (7, None), (8, 0)]
    frame = table(spark, [(*r, 1, "x") for r in rows], "doc_id long, n_tokens long, bin int, piece string")
    found = pack(frame, group=60).collect()
    assert sum(r["token_end"] - r["token_begin"] for r in found) == sum(n or 0 for _, n in rows)
    assert sum(r["bin"] is None for r in found) == sum(not n for _, n in rows)
    used = defaultdict(list)
    for r in found:
        if r["bin"] is not None:
            used[r["bin"]].append((r["bin_offset"], r["token_end"] - r["token_begin"], r["capacity"]))
    for pieces in used.values():
        pieces.sort()
        assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p[1] for p in pieces) <= pieces[0][2]
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append((r["token_begin"], r["token_end"]))
    for i, n in rows[:300]:
        if n and i not in (5, 7, 8):
            spans = sorted(by_doc[i])
            assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert pack(frame.limit(0)).count() == 0


def test_queries_count_tokens_exactly(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet").collect()
    counts = {r["doc_id"]: len(encoder().encode_ordinary(r["text"] or "")) for r in source}
    packed = defaultdict(int)
    for r in op6_best_fit_packing(spark, SF).collect():
        packed[r["doc_id"]] += r["token_end"] - r["token_begin"]
    assert packed == counts
    lengths = sorted(counts.values())
    counted = op10_token_counts(spark, SF)
    assert "MapInArrow" not in counted._jdf.queryExecution().toString()  # texts are encoded once, before
    rows = counted.collect()
    assert sorted(r["length"] for r in rows) == sorted(set(lengths))
    for r in rows:
        limit = r["length"]
        assert r["n_docs"] == lengths.count(limit) and r["docs_longer"] == sum(n > limit for n in lengths)
        assert r["tokens_longer"] == sum(n for n in lengths if n > limit) and r["tokens_total"] == sum(lengths)
        assert r["truncated_total"] == sum(min(n, limit) for n in lengths) == r["tokens_total"] - r["tokens_lost"]
        assert r["n_total"] == len(lengths) and abs(r["quantile"] - sum(n <= limit for n in lengths) / len(lengths)) < 1e-12


def plain_best_fit(lengths, capacities, overhead):
    """The method with plain lists: every open bin is looked at, and a new bin's size is tried against all that is left."""
    capacities, left = sorted(capacities), sorted(lengths, reverse=True)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins, put, clock = [], {}, 0  # a bin: space left, when it got it, content
    for i in order:
        n, clock = lengths[i], clock + 1
        left.remove(n)
        open_bins = [b for b in range(len(bins)) if bins[b][0] >= n]
        if open_bins:
            b = min(open_bins, key=lambda b: (bins[b][0], -bins[b][1]))
        else:
            def cost(size, n=n):
                space = size - n
                for m in left:
                    space -= m if m <= space else 0
                return (size + overhead) / (size - space), -size

            b = len(bins)
            bins.append([min((c for c in capacities if c >= n), key=cost), clock, 0])
        put[i] = (b, bins[b][2])
        bins[b] = [bins[b][0] - n, clock, bins[b][2] + n]
    return [(*put[i], min(c for c in capacities if c >= bins[put[i][0]][2])) for i in range(len(lengths))]


def test_packing_is_that_of_plain_lists():
    rng = random.Random(6)
    for sizes in ((50, 100, 200), (64,), (10, 35, 90)):
        for n in (1, 40, 250):
            lengths = [rng.choice([rng.randrange(1, max(sizes) + 1), 7, max(sizes) // 3]) for _ in range(n)]
            assert best_fit(lengths, sizes, 16) == plain_best_fit(lengths, sizes, 16)


def test_any_limit(spark):
    lengths = [0, 0, 3, 3, 5, 1023, 1024, 1025, 5000, None]
    histogram = length_histogram(table(spark, [(n, 1) for n in lengths], "n_tokens long, length int"))
    plain = [n or 0 for n in lengths]
    limits = table(spark, [(n,) for n in (0, 1, 3, 4, 1024, 4999, 5000, 9000)], "limit long")
    for r in totals_at(limits, histogram).collect():
        assert (r["truncated_total"], r["docs_cut"]) == (sum(min(n, r["limit"]) for n in plain), sum(n > r["limit"] for n in plain))
    assert totals_at(limits, histogram).count() == 8
    low = length_histogram(table(spark, [(10,), (20,)], "n_tokens long"))
    assert [(r["truncated_total"], r["docs_cut"]) for r in totals_at(table(spark, [(4,)], "limit long"), low).collect()] == [(8, 2)]
    odd = table(spark, [(None, 1), (-5, 1), (10**12, 1), (10**12, 2), (3000, 1)], "limit long, at int")
    found = sorted(tuple(r) for r in totals_at(odd, histogram).collect())
    assert found == [(-5, -5 * len(plain), len(plain)), (3000, sum(min(n, 3000) for n in plain), 1), *[(10**12, sum(plain), 0)] * 2]
    assert [tuple(r) for r in totals_at(table(spark, [(4,)], "limit long"), histogram.limit(0)).collect()] == [(4, 0, 0)]
    assert quantile_length(histogram, 0.5) == 3 and quantile_length(histogram, 1.0) == 5000
    doubled = merge_histograms(histogram, histogram)
    assert {(r["length"], r["n_docs"]) for r in doubled.collect()} == {(n, 2 * plain.count(n)) for n in plain}
    assert limit_table(histogram.limit(0)).count() == 0 and quantile_length(histogram.limit(0), 0.5) is None


def test_empty_texts():
    assert token_count(None) == token_count("") == 0 and token_count("<|endoftext|>") > 1
