"""Documents as files: names, odd texts, and what is refused."""

from __future__ import annotations

import pytest

from maskline.sources.documents import read_folder, write_folder

TEXTS = {
    "a.txt": "Zażółć\r\ngęślą\n",
    "deep/er/b with space.txt": "x" * 3_000_000,
    "100%+?#.txt": "﻿percent",
    "deep/empty.txt": "",
    "-.txt": "no line end",
}


def table(spark, rows, columns="doc_id string, text string"):
    return spark.createDataFrame(rows, columns)


def test_a_folder_comes_back_as_it_was(spark, tmp_path):
    docs = table(spark, [*TEXTS.items(), ("null.txt", None)]).repartition(3)
    write_folder(docs, str(tmp_path / "out"))
    files = sorted(str(f.relative_to(tmp_path / "out")) for f in (tmp_path / "out").rglob("*") if f.is_file())
    assert [f for f in files if "/." not in f and not f.startswith(".")] == sorted([*TEXTS, "null.txt"])
    for name, text in TEXTS.items():
        assert (tmp_path / "out" / name).read_bytes() == text.encode()
    back = {r.doc_id: r.text for r in read_folder(spark, str(tmp_path / "out")).collect()}
    assert {k: back.get(k, "") for k in TEXTS} == TEXTS and back.get("null.txt", "") == ""
    assert sorted(f.name for f in tmp_path.iterdir()) == ["out"]


def test_other_columns_and_no_rows(spark, tmp_path):
    docs = table(spark, [("a", "b", "c")], "name string, doc_id string, body string")
    write_folder(docs, str(tmp_path / "named"), name="name", text="body")
    assert (tmp_path / "named" / "a").read_text() == "c"
    write_folder(table(spark, []), str(tmp_path / "none"))
    assert list((tmp_path / "none").iterdir()) == []


@pytest.mark.parametrize("names", [[None], ["a", "a"], ["../a"], ["/a"], ["a//b"], ["a/"], [""], ["_a"], ["x/.a"], ["a/.."]])
def test_names_that_are_refused(spark, tmp_path, names):
    with pytest.raises(ValueError, match="not names of single files"):
        write_folder(table(spark, [(n, "x") for n in names]), str(tmp_path / "out"))
    assert list(tmp_path.iterdir()) == []


def test_a_folder_is_not_overwritten(spark, tmp_path):
    (tmp_path / "out").mkdir()
    with pytest.raises(FileExistsError):
        write_folder(table(spark, [("a", "x")]), str(tmp_path / "out"))


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    docs = table(spark, [("a", "x"), ("a/b", "y")])  # a file cannot be a folder too
    with pytest.raises(Exception):
        write_folder(docs.coalesce(1), str(tmp_path / "out"))
    assert list(tmp_path.iterdir()) == []


@pytest.mark.parametrize("folder", ["out/x/out", "with space+%", "łąka"])
def test_names_are_those_inside_the_folder(spark, tmp_path, folder):
    (tmp_path / folder).parent.mkdir(parents=True, exist_ok=True)
    write_folder(table(spark, [("out/a.txt", "1"), ("b", "2")]), str(tmp_path / folder))
    back = read_folder(spark, str(tmp_path / folder))
    assert sorted(map(tuple, back.collect())) == [("b", "2"), ("out/a.txt", "1")]
