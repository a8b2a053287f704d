import hashlib

from linkweave.llm import sharding

from cases import TEXTS, documents


def address(doc_id, text):
    def bits(value, digits):
        return int(hashlib.md5(("" if value is None else str(value)).encode()).hexdigest()[:digits], 16)

    return (bits(doc_id, 8) << 28) + bits(text, 7)


def brute(rows, limit):
    """Splits buckets one by one."""
    out, todo = {}, [(0, 0)]
    addressed = [(address(i, t), len((t or "").encode()), i) for i, t in rows]
    while todo:
        depth, prefix = todo.pop()
        inside = [r for r in addressed if r[0] >> (60 - depth) == prefix]
        if sum(r[1] for r in inside) <= limit or depth == 60:
            for r in inside:
                out.setdefault(r[0], (depth, prefix))
        else:
            todo += [(depth + 1, 2 * prefix), (depth + 1, 2 * prefix + 1)]
    return out


def check(spark, rows, limit):
    got = sharding.assign_shards(documents(spark, rows), limit).collect()
    assert sorted((str(r.doc_id), r.bytes) for r in got) == sorted((str(i), len((t or "").encode())) for i, t in rows)
    wanted = brute(rows, limit)
    sizes = {}
    for r in got:
        assert (r.depth, r.prefix) == wanted[r.address]
        sizes.setdefault((r.depth, r.prefix, r.page), []).append(r.bytes)
    assert all(sum(s) <= limit or len(s) == 1 for s in sizes.values())
    return got


def test_cases(spark):
    for limit in (30, 1000, 1 << 30):
        check(spark, TEXTS, limit)
    assert sharding.assign_shards(documents(spark).limit(0)).count() == 0


def test_many_documents(spark):
    check(spark, [(i, "x" * (i % 97)) for i in range(2000)], 500)


def test_repeated_rows_get_pages(spark):
    rows = [(1, "y" * 100)] * 50 + [(1, "z" * 100)] * 5 + [(2, "w")]
    got = check(spark, rows, 1000)
    assert len({(r.depth, r.prefix, r.page) for r in got if r.bytes == 100}) == 6


def test_written_shards_hold_every_row(spark, tmp_path):
    rows = [*TEXTS, *[(20, "same")] * 30]
    sharding.write_shards(documents(spark, rows), str(tmp_path / "out"), 50)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(map(str, rows))


def test_directory(spark):
    shards = sharding.directory(sharding.assign_shards(documents(spark), 1000)).collect()
    assert sum(s.documents for s in shards) == len(TEXTS)
