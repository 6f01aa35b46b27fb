"""Records cut in parallel against a sequential reader."""

import csv
import io
import random

import pytest

from tablegauge.sources import quoted
from tablegauge.sources.delimited import SourceError, read_delimited


def table(seed, newline="\n", n=160):
    random.seed(seed)
    cell = lambda: random.choice(
        ["x", "", "two words", 'say "hi"', "a,b", "line\nbreak", "\n\n", 'q"\n"q', 'inch 5"', "ünï日本", "1.5", "," * 3 + "\n"]
    )
    rows = [["id", "a", "b c", "d"]] + [[str(i), cell(), cell(), "end"] for i in range(n)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=newline)
    writer.writerows(rows)
    return rows, out.getvalue()


@pytest.mark.parametrize("range_bytes", ["128m", "200", "61"])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_ranges_give_the_rows_of_one_task(spark, tmp_path, range_bytes, newline):
    rows, text = table(len(range_bytes), newline)
    (tmp_path / "t.csv").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_delimited(spark, str(tmp_path / "t.csv"), typed=False, row_id="n", multi_line=True).orderBy("n").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [[r[c] or "" for c in rows[0]] for r in got] == rows[1:]


@pytest.mark.parametrize("encoding", ["utf-8-sig", "shift_jis", "gb18030", "euc_jp", "big5", "cp1251"])
def test_encodings(spark, tmp_path, encoding):
    words = {"cp1251": "слово", "big5": "中文"}.get(encoding, "日本表")
    text = f'имя,n\n"{words}\n{words}",1\n{words},2\n' if encoding == "cp1251" else f'{words},n\n"{words}\n|{words}",1\n{words},2\n'
    (tmp_path / "t.csv").write_bytes(text.encode(encoding))
    df = read_delimited(spark, str(tmp_path / "t.csv"), encoding=encoding, multi_line=True)
    name, _ = df.columns
    assert name == ("имя" if encoding == "cp1251" else words)
    sep = "" if encoding == "cp1251" else "|"
    assert sorted(tuple(r) for r in df.collect()) == sorted([(f"{words}\n{sep}{words}", 1), (words, 2)])


def test_wide_encodings_and_unknown_ones_are_told(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("a,b\n1,2\n".encode("iso2022_jp"))
    for encoding in ("iso2022_jp", "no such"):
        with pytest.raises(SourceError):
            read_delimited(spark, str(tmp_path / "t.csv"), encoding=encoding)
    with pytest.raises(SourceError):
        read_delimited(spark, str(tmp_path / "missing.csv"), multi_line=True)
    (tmp_path / "empty.csv").write_bytes(b"")
    with pytest.raises(SourceError):
        read_delimited(spark, str(tmp_path / "empty.csv"), multi_line=True)


def test_files_of_a_folder_have_headers_of_their_own(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for name, rows in (("a", '1,"x\ny"\n\n2,z\n'), ("b", "3,w")):
        (tmp_path / "f" / name).write_text("k,v\n" + rows)
    got = read_delimited(spark, str(tmp_path / "f"), row_id="n", multi_line=True).orderBy("n").collect()
    assert [(r.k, r.v) for r in got] == [(1, "x\ny"), (2, "z"), (3, "w")]


def test_states_are_those_of_a_sequential_reader():
    random.seed(4)
    for sep in (",", ";", "||"):
        states = quoted.QuoteStates(sep)
        for _ in range(400):
            lines = ["".join(random.choices(['"', sep, "a", '""'], k=random.randint(0, 9))) for _ in range(4)]
            inside = False
            for line in lines:
                want, at, start = inside, 0, not inside
                while at < len(line):
                    if want:
                        if line[at] == '"':
                            if line[at : at + 2] == '""':
                                at += 1
                            else:
                                want, start = False, False
                        at += 1
                    elif start and line[at] == '"':
                        want, at = True, at + 1
                    elif line.startswith(sep, at):
                        start, at = True, at + len(sep)
                    else:
                        start, at = False, at + 1
                assert states.after(line, inside) == want, (line, inside)
                inside = want
