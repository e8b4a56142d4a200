"""Edition scans: every way of reading gives the same rows, cell by cell."""

from __future__ import annotations

import csv
import io
import random
from collections import Counter

import pandas
import pytest

from surveymill.sources import survey_csv
from surveymill.sources.landing import land, land_downloads, land_edition, pick_largest, read_landed
from surveymill.sources.landing import changed_sources, read_landed_editions, read_manifest
from surveymill.sources.survey_csv import clean, csv_files, scan_edition, scan_editions, unique_names

WORDS = ["a", "b c", 'diz "sim"', '"', '""', "x,y", "linha\noutra", "\n", '\n"\n', "fim\r\nde", "so\rcr", "ç", "", " ", "\x01", '","', "NA", "1,\n2"]


def _rows(rng, count, words, width=4):
    rows = [["".join(rng.choice(words) for _ in range(rng.choice([0, 1, 1, 3]))) for _ in range(width)] for _ in range(count)]
    for n, row in enumerate(rows):
        row[0] = f"id{n}{row[0]}"
    return rows


def _write(path, header, rows, line_end="\n", quoting=csv.QUOTE_MINIMAL):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = io.StringIO()
    csv.writer(text, lineterminator=line_end, quoting=quoting).writerows([header, *rows])
    path.write_bytes(text.getvalue().encode())


def _cells(edition):
    return Counter(tuple(row) for row in edition.rows.collect())


def _expected(rows):
    return Counter(tuple(cell or None for cell in row) for row in rows)


def _blank_as_null(counter):
    return Counter({tuple(c or None for c in row): n for row, n in counter.items()})


@pytest.fixture
def small_splits(conf):
    conf("spark.sql.files.maxPartitionBytes", "1500")
    conf("spark.sql.files.openCostInBytes", "0")


HEADER = ["('P0 ', 'id, \"x\"')", "a.b", "a.b", "linha\ndois"]


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_records_that_span_lines(spark, tmp_path, small_splits, line_end, quoting):
    rng = random.Random(3)
    first, second = _rows(rng, 900, WORDS), _rows(rng, 300, WORDS)
    _write(tmp_path / "e" / "one.csv", HEADER, first, line_end, quoting)
    _write(tmp_path / "e" / "two.csv", HEADER, second, line_end, quoting)
    edition = scan_edition(spark, str(tmp_path / "e"))
    assert edition.headers == [HEADER[0], "a.b", "a.b.1", HEADER[3]]
    assert edition.rows.rdd.getNumPartitions() == 2  # a file is one task's work
    assert _blank_as_null(_cells(edition)) == _expected(first + second)


def test_a_file_gives_the_same_rows_whatever_the_split_size(spark, tmp_path, conf):
    rows = _rows(random.Random(4), 300, WORDS)
    _write(tmp_path / "e" / "one.csv", HEADER, rows)
    assert _blank_as_null(_cells(scan_edition(spark, str(tmp_path / "e")))) == _expected(rows)
    conf("spark.sql.files.maxPartitionBytes", "700")
    conf("spark.sql.files.openCostInBytes", "0")
    assert _blank_as_null(_cells(scan_edition(spark, str(tmp_path / "e")))) == _expected(rows)


def test_very_long_cells(spark, tmp_path, small_splits):
    rows = [["id0", "x"], ["id1", 'longa\n"linha" ' * 900], ["id2", "y\n"], ["id3", "\n" * 4000], ["id4", "z " * 3000 + '"']]
    _write(tmp_path / "big.csv", ["id", "text"], rows)
    assert _blank_as_null(_cells(scan_edition(spark, str(tmp_path / "big.csv")))) == _expected(rows)


def test_a_header_larger_than_several_splits(spark, tmp_path, small_splits):
    header = ["id", "linha\n" * 2000]
    _write(tmp_path / "h.csv", header, [["a", "b"], ["c", "d\ne"]])
    edition = scan_edition(spark, str(tmp_path / "h.csv"))
    assert edition.headers == header and _cells(edition) == _expected([["a", "b"], ["c", "d\ne"]])


def test_a_header_that_never_ends(spark, tmp_path):
    (tmp_path / "h.csv").write_text('id,"a\n' + "1,2\n" * 5000)
    with pytest.raises(ValueError, match="never closed"):
        scan_edition(spark, str(tmp_path / "h.csv"))


def test_files_of_mixed_kinds(spark, tmp_path, small_splits):
    flat, spanning = [[f"a{n}", "x"] for n in range(200)], [[f"b{n}", "x\ny"] for n in range(200)]
    _write(tmp_path / "e" / "a b.csv", ["id", "t"], flat)
    _write(tmp_path / "e" / "b.csv", ["id", "t"], spanning)
    assert _cells(scan_edition(spark, str(tmp_path / "e"))) == _expected(flat + spanning)


def test_irregular_quotes_are_kept(spark, tmp_path):
    lines = ["id,a"] + [f'id{n},5" tela' if n % 50 == 0 else f'id{n},"x"s' if n % 50 == 1 else f'id{n},"x\ny"' for n in range(400)]
    (tmp_path / "odd.csv").write_text("\n".join(lines) + "\n")
    rows = _cells(scan_edition(spark, str(tmp_path / "odd.csv")))
    assert sum(rows.values()) == 400 and rows["id50", '5" tela'] == rows["id51", '"x"s'] == rows["id52", "x\ny"] == 1


@pytest.mark.parametrize("seed", range(6))
def test_random_files(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    rows = _rows(rng, rng.choice([1, 40, 700]), rng.sample(WORDS, rng.randint(3, len(WORDS))), width=3)
    _write(tmp_path / "r.csv", ["id", "b", "c"], rows, rng.choice(["\n", "\r\n"]))
    assert _blank_as_null(_cells(scan_edition(spark, str(tmp_path / "r.csv")))) == _expected(rows)


@pytest.mark.parametrize("seed", range(8))
def test_texts_are_read_as_pandas_reads_them(spark, tmp_path, seed):
    """Cells plain or quoted, blank lines, short records and long ones."""
    rng = random.Random(seed)
    plain = ["a", "b c", "  ", "q\"q", "é", "", "1", "x\ty"]
    quoted = ['"x"', '"p""q"', '"l1\nl2"', '"a,b"', '""', '"\r\n"', '" "', '"\n\n"']
    blank = ["", "   ", "\t"]
    records = []
    for _ in range(120):
        cells = [rng.choice(plain + quoted) for _ in range(rng.choice([1, 2, 2, 2, 2, 3 if seed % 2 else 2]))]
        records.append(rng.choice(blank) if rng.random() < 0.1 else ",".join(cells))
    text = "id,b\n" + "\n".join(records) + "\n"
    (tmp_path / "t.csv").write_bytes(text.encode())
    if seed % 2:
        with pytest.raises(Exception, match="3 cells, the header has 2"):
            scan_edition(spark, str(tmp_path / "t.csv")).rows.collect()
        return
    frame = pandas.read_csv(io.StringIO(text, newline=""), dtype=str, keep_default_na=False, index_col=False, skipinitialspace=False)
    expected = Counter(tuple(c if isinstance(c, str) and c else None for c in row) for row in frame.itertuples(index=False, name=None))
    got = _blank_as_null(_cells(scan_edition(spark, str(tmp_path / "t.csv"))))
    # a record of one cell of blanks is a blank line, quoted or not
    assert {k: n for k, n in got.items() if (k[0] or "").strip() or k[1]} == {k: n for k, n in expected.items() if (k[0] or "").strip() or k[1]}


@pytest.mark.parametrize("tail", ['"x\ny",z', "x,z", '"a, b"c,z'])
def test_blank_lines_are_no_records(spark, tmp_path, conf, tail):
    (tmp_path / "b.csv").write_text(f"\n  \na,b\n1,2\n   \n\t\n\n3,4\n{tail}\n \n")
    for split in ("100000", "8"):
        conf("spark.sql.files.maxPartitionBytes", split)
        conf("spark.sql.files.openCostInBytes", "0")
        first = ['"a, b"c', "z"] if tail.startswith('"a, b"c') else next(csv.reader(io.StringIO(tail)))
        assert _cells(scan_edition(spark, str(tmp_path / "b.csv"))) == _expected([["1", "2"], ["3", "4"], first])


@pytest.mark.parametrize("record", ["3,4,EXTRA", "3,4,", '"3\n",4,x', '"3,",",4",","'])
def test_records_longer_than_the_header_are_errors(spark, tmp_path, record):
    (tmp_path / "l.csv").write_text(f"a,b\n1,2\n{record}\n")
    with pytest.raises(Exception, match="3 cells, the header has 2"):
        scan_edition(spark, str(tmp_path / "l.csv")).rows.collect()


def test_files_with_different_headers_are_an_error(spark, tmp_path):
    _write(tmp_path / "e" / "a.csv", ["idade", "genero"], [["40", "M"]])
    _write(tmp_path / "e" / "b.csv", ["genero", "idade"], [["M", "40"]])
    with pytest.raises(ValueError, match="different headers"):
        scan_edition(spark, str(tmp_path / "e"))
    _write(tmp_path / "e" / "b.csv", ["idade", "genero"], [["41", "F"]])
    assert _cells(scan_edition(spark, str(tmp_path / "e"))) == _expected([["40", "M"], ["41", "F"]])


def test_null_tokens_and_short_records(spark, tmp_path):
    (tmp_path / "n.csv").write_text('a,b,c\n"",NA,nan\nNULL,<NA>,x\n"NA",y\n\n ,"n/a",0\n')
    rows = clean(scan_edition(spark, str(tmp_path / "n.csv")).rows).collect()
    assert [tuple(r) for r in rows] == [(None,) * 3, (None, None, "x"), (None, "y", None), (" ", None, "0")]


@pytest.mark.parametrize(
    "row, names",
    [
        (["x", "x", "x"], ["x", "x.1", "x.2"]),
        (["x", "x.1", "x"], ["x", "x.1", "x.2"]),
        (["x", "x", "x.1"], ["x", "x.2", "x.1"]),
        (["a", None, ""], ["a", "Unnamed: 1", "Unnamed: 2"]),
        (["x", "X"], ["x", "X"]),
    ],
)
def test_unique_names(row, names):
    assert unique_names(row) == names


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        pick_largest(spark, str(tmp_path))


def test_landing_keeps_cells_and_headers(spark, tmp_path):
    rows = _rows(random.Random(9), 60, WORDS)
    _write(tmp_path / "dl" / "deep" / "main.csv", HEADER, rows)
    _write(tmp_path / "dl" / "small.csv", HEADER, rows[:5])
    (tmp_path / "dl" / "notes.txt").write_text("x" * 100000)
    largest = pick_largest(spark, str(tmp_path / "dl"))
    assert largest.endswith("deep/main.csv")
    sizes = {r["path"].rsplit("/", 1)[1]: r["length"] for r in csv_files(spark, str(tmp_path / "dl")).collect()}
    assert sizes == {"main.csv": (tmp_path / "dl/deep/main.csv").stat().st_size, "small.csv": (tmp_path / "dl/small.csv").stat().st_size}
    landed = land_downloads(spark, {2024: str(tmp_path / "dl")}, str(tmp_path / "bronze"))
    assert landed == {2024: f"{tmp_path}/bronze/survey_year=2024"}
    edition, source = read_landed(spark, landed[2024]), scan_edition(spark, largest)
    assert edition.headers == source.headers == [HEADER[0], "a.b", "a.b.1", HEADER[3]]
    assert _cells(edition) == _cells(source)
    land_edition(spark, str(tmp_path / "dl" / "small.csv"), str(tmp_path / "bronze"), 2024)
    assert read_landed(spark, landed[2024]).rows.count() == 5


def _editions(root, years, rng):
    """Editions of their own widths, headers in their own order; the rows by year."""
    rows = {}
    for year in years:
        width = rng.randint(1, 6)
        rows[year] = [[f"{year}-{n}", *(rng.choice(["x", "a,b", "l1\nl2", ""]) for _ in range(width - 1))] for n in range(rng.randint(0, 3))]
        _write(root / f"survey_year={year}" / "survey.csv", [f"h{year}-{pos}" for pos in range(width)], rows[year])
    return rows


def test_many_editions_in_one_plan(spark, tmp_path):
    """The same rows as one by one; jobs and plan do not grow with the number of editions."""
    seen = {}
    for n in (3, 60):
        root = tmp_path / str(n)
        rows = _editions(root, range(2000, 2000 + n), random.Random(n))
        paths = {year: f"{root}/survey_year={year}" for year in rows}
        spark.sparkContext.setJobGroup(f"editions-{n}", "count")
        editions = scan_editions(spark, paths)
        found = editions.rows.collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"editions-{n}"))
        spark.sparkContext.setJobGroup("other", "other")
        width = len(editions.rows.columns) - 1
        expected = Counter((year, *(c or None for c in row), *[None] * (width - len(row))) for year, own in rows.items() for row in own)
        assert Counter(tuple(c or None for c in r) for r in found) == expected
        headers = {(r.survey_year, r.pos): r.header for r in editions.catalog.collect()}
        assert all(text == f"h{year}-{pos}" for (year, pos), text in headers.items()) and len({y for y, _ in headers}) == n
        plan = editions.rows._jdf.queryExecution().optimizedPlan().toString()
        seen[n] = (jobs, plan.count("Relation"), plan.count("Join"), plan.count("Union"))
    assert seen[3] == seen[60] or (seen[60][0] <= seen[3][0] + 3 and seen[3][1:] == seen[60][1:])


def test_rejected_records(spark, tmp_path):
    (tmp_path / "survey_year=2023").mkdir()
    (tmp_path / "survey_year=2024").mkdir()
    (tmp_path / "survey_year=2023" / "s.csv").write_text('a,b\n1,2\n3,4,\n5,"x\ny",z\n6,"p,q"\n7,8,,,\n9\n"a,b",","\n')
    (tmp_path / "survey_year=2024" / "s.csv").write_text("a,b,c,d\n1,2,3,4\n1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16\n1,2,3\n,,,,\n")
    paths = {year: f"{tmp_path}/survey_year={year}" for year in (2023, 2024)}
    editions = scan_editions(spark, paths, rejects=True)
    assert Counter(map(tuple, editions.rows.select("survey_year", "c0", "c1", "c2").collect())) == Counter([
        (2023, "1", "2", None), (2023, "6", "p,q", None), (2023, "9", None, None), (2023, "a,b", ",", None), (2024, "1", "2", "3"), (2024, "1", "2", "3"),
    ])
    rejected = {r.record: (r.survey_year, r.reason) for r in editions.rejects.collect()}
    reason = "a record has {} cells, the header has {}".format
    assert rejected["3,4,"] == (2023, reason(3, 2)) and rejected['5,"x\ny",z'] == (2023, reason(3, 2)) and rejected["7,8,,,"] == (2023, reason(5, 2))
    assert rejected[",,,,"] == (2024, reason(5, 4)) and rejected["1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16"] == (2024, reason(13, 4))
    assert len(rejected) == 5 and all("survey_year=" in r.file for r in editions.rejects.collect())
    with pytest.raises(Exception, match="cells, the header has"):
        scan_editions(spark, paths).rows.collect()


def test_leading_blank_lines_in_some_files(spark, tmp_path):
    (tmp_path / "survey_year=1").mkdir()
    (tmp_path / "survey_year=1" / "a.csv").write_text("  \n\t\na,b\n1,2\na,b\n")
    (tmp_path / "survey_year=1" / "b.csv").write_text("a,b\n3,4\n \n")
    editions = scan_editions(spark, {1: f"{tmp_path}/survey_year=1"})
    assert Counter(map(tuple, editions.rows.collect())) == Counter([(1, "1", "2"), (1, "a", "b"), (1, "3", "4")])


def test_landing_again_writes_what_changed(spark, tmp_path):
    rng = random.Random(5)
    rows = _editions(tmp_path / "dl", (2023, 2024, 2025), rng)
    folders = {year: f"{tmp_path}/dl/survey_year={year}" for year in rows}
    bronze = f"{tmp_path}/bronze"
    files = lambda year: {f.name: f.stat().st_mtime_ns for f in (tmp_path / "bronze" / f"survey_year={year}").glob("part-*")}
    land_downloads(spark, folders, bronze)
    first = {year: files(year) for year in rows}
    land_downloads(spark, folders, bronze)
    assert {year: files(year) for year in rows} == first
    _write(tmp_path / "dl" / "survey_year=2024" / "survey.csv", ["new", "header"], [["a", "b"], ["c", "d"]])
    sources = csv_files(spark, f"{tmp_path}/dl").selectExpr("CAST(regexp_extract(path, 'survey_year=([0-9]+)', 1) AS INT) AS survey_year", "file", "length", "modified")
    assert [r.survey_year for r in changed_sources(sources, read_manifest(spark, bronze)).collect()] == [2024]
    land_downloads(spark, folders, bronze)
    assert {year: files(year) for year in (2023, 2025)} == {year: first[year] for year in (2023, 2025)} and files(2024) != first[2024]
    edition = read_landed(spark, f"{bronze}/survey_year=2024")
    assert edition.headers == ["new", "header"] and _cells(edition) == _expected([["a", "b"], ["c", "d"]])
    editions = read_landed_editions(spark, bronze, [2023, 2024, 2025])
    assert editions.rows.count() == len(rows[2023]) + 2 + len(rows[2025])
    with pytest.raises(FileNotFoundError, match="2022"):
        read_landed_editions(spark, bronze, [2022, 2023])


def test_landed_files_are_bounded(spark, tmp_path):
    _write(tmp_path / "s.csv", ["a", "b"], [[str(n), "x"] for n in range(1000)])
    sources = csv_files(spark, f"{tmp_path}/s.csv").selectExpr("2024 AS survey_year", "file", "length", "modified")
    assert land(spark, sources, f"{tmp_path}/bronze", max_records=300) == [2024]
    assert len(list((tmp_path / "bronze" / "survey_year=2024").glob("part-*"))) == 4


def test_text_after_a_closing_quote_is_read_as_pandas_reads_it(spark, tmp_path):
    """The quotes go, whatever the cell holds, also from records narrower than the widest edition's; whole cells keep theirs."""
    odd = ['"web"s', '"a""b"s', '"a"b"s', '"a"""s', '""x"s', '"a,b"s', '"a\nb"s', '"a"s "b', '"l""\n""m"t', '""""x', '"p"  x']
    whole = ['"""web""s"', '""""', '"""a"",""b"" c"', ' "x"s', '5" tela', '""', '"""q"""', "z"]
    cells = [*odd, *whole, *odd[:3]]
    records = [f"id{n},{a},{b}" for n, a in enumerate(cells) for b in (cells[n - 1], "z", "")]
    text = "id,a,b\n" + "\n".join(records) + '\nend,"x"s\n'
    (tmp_path / "survey_year=2023").mkdir()
    (tmp_path / "survey_year=2024").mkdir()
    (tmp_path / "survey_year=2023" / "s.csv").write_text(text)
    (tmp_path / "survey_year=2024" / "s.csv").write_text("a,b,c,d,e\n1,2,3,4,5\n")
    frame = pandas.read_csv(io.StringIO(text, newline=""), dtype=str, keep_default_na=False, index_col=False)
    expected = Counter(tuple(c if isinstance(c, str) and c else None for c in row) for row in frame.itertuples(index=False, name=None))
    one = scan_edition(spark, f"{tmp_path}/survey_year=2023", close_quotes=True)
    assert _blank_as_null(_cells(one)) == expected
    both = scan_editions(spark, {year: f"{tmp_path}/survey_year={year}" for year in (2023, 2024)}).rows
    assert _blank_as_null(Counter(map(tuple, both.filter("survey_year = 2023").select("c0", "c1", "c2").collect()))) == expected


def test_headers_of_one_line_are_found_without_parsing_files(spark, tmp_path, monkeypatch):
    """Only files whose header may be more than their first line are parsed for it; all give the same header."""
    parsed = []
    parse = survey_csv._parsed_first_records
    monkeypatch.setattr(survey_csv, "_parsed_first_records", lambda spark, paths, folder: parsed.extend(paths) or parse(spark, paths, folder))
    texts = {"a": "x,y z\n1,2\n", "b": '\n  \n"x","y z"\r\n1,"2\n3"\r\n', "bom": "\ufeffx,y z\n1,2\n", "none": "\n \n", "empty": ""}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    (tmp_path / "long.csv").write_text('x,"y\nz"\n1,2\n')
    heads = {r["file"].rsplit("/", 1)[1]: (r["header"], r["closed"], r["blank"] > 0) for r in survey_csv.first_records(spark, str(tmp_path)).collect()}
    same = ["x", "y z"]
    assert heads == {"a.csv": (same, True, False), "b.csv": (same, True, True), "bom.csv": (same, True, False), "long.csv": (["x", "y\nz"], True, False)}
    assert sorted(path.rsplit("/", 1)[1] for path in parsed) == ["long.csv", "none.csv"]


def test_a_carriage_return_within_a_short_record_is_kept(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes(b'a,b,c,d\r\n"x\r",y\r\n"p\r",q,,s\r\n')
    assert _cells(scan_edition(spark, str(tmp_path / "r.csv"))) == _expected([["x\r", "y", None, None], ["p\r", "q", None, "s"]])
