import csv
import io
import random

import numpy as np
import pyarrow as pa
import pytest

from moodtide.sources import landing, split_csv

HEADER = ["feature_a", "subreddit", "author", "date", "post", "feature_b"]


def rows_of(seed, n):
    rng = random.Random(seed)
    texts = ["plain", 'say "hi"', "a,b", "line\nbreak", '"', '""', "x\n\n\ny", ',"', 'end"', '"\n"', "", None, "ünï, \"c\"\n日本", "c\r\nd", "tail,\n", "w" * 90 + "\n" + "v" * 90]
    return [[str(k), rng.choice(["sleep", "adhd"]), rng.choice(texts), f"2020/01/{k % 28 + 1:02d}", rng.choice(texts), rng.choice(["", "1"])] for k in range(n)]


def text_of(rows, end="\n", quoting=csv.QUOTE_MINIMAL, header=HEADER):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=quoting)
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


@pytest.fixture
def split(spark):
    """Ranges of about ``n`` bytes."""
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def by(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield by
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def bronze(df):
    return sorted((tuple(r) for r in df.drop("ingested_at").collect()), key=str)


def expected(folder):
    """By Python's own reader; an empty field is a missing value."""
    out = []
    for path in folder.iterdir():
        text = path.read_bytes().decode().replace("\n\n2,", "\n2,")
        for row in list(csv.DictReader(io.StringIO(text, newline=""))):
            values = [row[c] or None for c in ("subreddit", "author", "date", "post")]
            out.append((*values, path.name.split("_")[1], path.name))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [67, 1 << 20])
def test_rows_equal_those_of_readers_of_whole_files(spark, split, tmp_path, size):
    quotings = [csv.QUOTE_MINIMAL, csv.QUOTE_ALL, csv.QUOTE_MINIMAL, csv.QUOTE_MINIMAL]
    for k, (quoting, end) in enumerate(zip(quotings, ["\n", "\n", "\r\n", "\n"])):
        rows = rows_of(k, 60)
        if k == 3:
            rows = [[*r[:4], "plain", r[5]] for r in rows if r[2] and "\n" not in r[2] and '"' not in r[2]]  # no quotes at all
        (tmp_path / f"sleep_p{k}_posts.csv").write_bytes(text_of(rows, end, quoting).encode())
    (tmp_path / "adhd_stray_posts.csv").write_text(",".join(HEADER) + '\n1,adhd,5" pipe,2020/01/01,"a ""b"" c",\n\n2,adhd,x,2020/01/02,it is 6" or 7",\n')
    (tmp_path / "adhd_empty_posts.csv").write_text("")
    (tmp_path / "adhd_header_posts.csv").write_text(",".join(HEADER))
    split(size)
    found = split_csv.ranges(spark, str(tmp_path))
    got = bronze(split_csv.land(spark, str(tmp_path)))
    want = expected(tmp_path)
    assert [r[1:] for r in got if r[1:] not in want] == []
    assert sorted((r[1:] for r in got), key=str) == want and len(want) > 150
    # The reader of one task turns the line ends inside quotes of the third file to line feeds; all else is equal.
    same = lambda rows: [r for r in rows if r[-1] != "sleep_p2_posts.csv"]
    assert same(got) == same(bronze(landing.land_csv(spark, str(tmp_path))))
    if size == 67:
        assert found.where("opened").count() > 20 and found.count() > 100


def test_a_large_file_is_read_by_many_tasks(spark, split, tmp_path):
    body = text_of([[str(k), "sleep", f"a{k}", "2020/01/01", f'long "text"\nnumber {k}\n' * 20, ""] for k in range(4000)])
    (tmp_path / "sleep_pre_posts.csv").write_text(body)
    split(len(body) // 9)
    lines = split_csv._lines(spark, [str(tmp_path)])
    assert lines.rdd.getNumPartitions() >= 8
    assert split_csv.ranges(spark, str(tmp_path)).count() >= 8
    out = split_csv.land(spark, str(tmp_path))
    assert out.count() == out.select("post_id").distinct().count() == 4000


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "sleep_pre_posts.csv").write_text(text_of([["1", "sleep", "ann", "2020/01/01", "x", ""]]))
    (tmp_path / "adhd_pre_posts.csv").write_bytes(("﻿" + text_of([["y\nz", "2020/01/02", "adhd", "bob"]], "\r\n", header=["post", "date", "subreddit", "author"])).encode())
    (tmp_path / "adhd_post_posts.csv").write_text('post,"a\nb",date,subreddit,author\nw,,2020/01/03,adhd,cy\n')
    got = {(r["author"], r["post"], r["created_date"]) for r in split_csv.land(spark, str(tmp_path)).collect()}
    assert got == {("ann", "x", "2020/01/01"), ("bob", "y\nz", "2020/01/02"), ("cy", "w", "2020/01/03")}
    (tmp_path / "adhd_2018_posts.csv").write_text("post,date\n1,2\n")
    with pytest.raises(ValueError, match="subreddit"):
        split_csv.land(spark, str(tmp_path))


def test_states_beyond_the_broadcast_bound_are_joined(spark, split, tmp_path, monkeypatch):
    (tmp_path / "sleep_pre_posts.csv").write_text(text_of(rows_of(9, 80)))
    split(50)
    want = bronze(landing.land_csv(spark, str(tmp_path)))
    monkeypatch.setattr(split_csv, "RANGES_AT_ONCE", 3)
    assert bronze(split_csv.land(spark, str(tmp_path))) == want


def test_no_rows(spark, tmp_path):
    (tmp_path / "a_pre_posts.csv").write_text("")
    out = split_csv.land(spark, str(tmp_path))
    assert out.count() == 0 and "post_id" in out.columns


def test_states_are_those_of_a_reader_of_single_characters():
    rng = random.Random(1)
    for _ in range(300):
        lines = ["".join(rng.choices('",a', [5, 3, 4], k=rng.randrange(9))) for _ in range(6)]
        for opened in (False, True):
            inside, field, want = opened, True, [opened]
            for line in lines:
                k, field = 0, True
                while k < len(line):
                    n = len(line[k:]) - len(line[k:].lstrip('"'))
                    if n:
                        if inside:
                            inside = n % 2 == 0
                        elif field:
                            inside = n % 2 == 1
                        field, k = False, k + n
                    else:
                        field, k = line[k] == ",", k + 1
                want.append(inside)
            assert split_csv.states(split_csv.quotes(pa.array(lines)), opened).tolist() == want
    assert split_csv.states(split_csv.quotes(pa.array([], pa.string())), True).tolist() == [True]
    assert np.array_equal(split_csv.quotes(pa.array(["x", None])).flips, [False, False])
