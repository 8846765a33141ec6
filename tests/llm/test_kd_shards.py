import zlib
from collections import Counter, defaultdict

import pytest
from helpers import docs_table, odd_rows, prose, with_clashes

from cohortica.llm.kd_shards import kd_shards


def check(rows, got, shards, spread):
    texts = Counter((r[0], zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()) + 1) for r in rows)
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in got) == texts
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        ids = [r.doc_id if r.doc_id is not None else -1 for r in sorted(members, key=lambda r: r.slot)]
        assert ids == sorted(ids)
    sizes = [sum(r.size for r in by[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= spread * sum(sizes) / shards, sizes
    return by


def test_equal_bytes_and_whole_groups(spark):
    rows = [(k, prose(k % 700, 20 + k % 90), "en", f"src{k % 3 * (k % 2)}", 0) for k in range(1200)]
    got = kd_shards(with_clashes(docs_table(spark, rows)), shards=8).collect()
    by = check(rows, got, 8, 0.1)
    home = defaultdict(set)
    for k, members in by.items():
        for r in members:
            home[(r.text_crc32, r.size)].add(k)
    assert all(len(v) == 1 for v in home.values())


def test_a_text_that_is_half_of_all_rows_is_cut(spark):
    rows = [(k, "hot text of some length" if k % 2 else prose(k, 4), "en", "s", 0) for k in range(1000)]
    check(rows, kd_shards(docs_table(spark, rows), shards=8).collect(), 8, 0.25)


def test_target_bytes_and_odd_numbers(spark):
    rows = [(k, "x" * 99, "en", "s", 0) for k in range(300)]
    got = kd_shards(docs_table(spark, rows), target_bytes=6_000).collect()
    check(rows, got, 5, 0.3)
    with pytest.raises(ValueError):
        kd_shards(docs_table(spark, rows))


def test_awkward_rows_and_no_rows(spark):
    rows = odd_rows()
    check(rows, kd_shards(docs_table(spark, rows), shards=4).collect(), 4, 10)
    assert kd_shards(docs_table(spark, []), shards=4).collect() == []
    assert [r.shard for r in kd_shards(docs_table(spark, rows[:1]), shards=1).collect()] == [0]
