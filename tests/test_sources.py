from __future__ import annotations

import glob
import json
import tempfile

import pytest

from tallyweave.plans import busy_report, exploration_report, itemset_report
from tallyweave.sources import (
    read_baskets,
    read_businesses,
    read_reviews,
    read_words,
    write_busy_report,
    write_category_report,
    write_itemsets,
    write_report,
    write_similar_pairs,
)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def put(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


def objects(path):
    found = []
    for name in sorted(glob.glob(f"{path}/**/*.json", recursive=True)):
        with open(name, encoding="utf-8") as lines:
            found += [json.loads(line) for line in lines]
    return found


def test_baskets(spark, folder, rows_of):
    path = put(folder, "in.csv", 'user,item\n1, "a"\n1,\n2,b\\\nuser,item\n')
    # every row that equals the header goes, as in the inventory (S3, P13)
    assert rows_of(read_baskets(spark, path)) == [("1", ""), ("1", ' "a"'), ("2", "b\\")]
    assert rows_of(read_baskets(spark, path, swap=True)) == [("", "1"), (' "a"', "1"), ("b\\", "2")]
    assert ("user", "item") in rows_of(read_baskets(spark, path, header=False))


def test_baskets_of_another_width(spark, folder, rows_of):
    path = put(folder, "wide.csv", "user,item\n1,a,x\n2,b\n3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_baskets(spark, path).collect()
    assert rows_of(read_baskets(spark, path, mode="DROPMALFORMED")) == [("2", "b")]


def test_reviews(spark, folder):
    good = '{"user_id": "u", "business_id": "b", "stars": 4, "date": "2018-01-01", "text": "t", "other": 1}\n'
    path = put(folder, "reviews.json", good)
    row = read_reviews(spark, path, strict=True).first()
    assert (row.user_id, row.stars, row.review_id) == ("u", 4.0, None)
    bad = put(folder, "bad.json", good + "{broken\n")
    assert read_reviews(spark, bad).filter("user_id is not null").count() == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        read_reviews(spark, bad, strict=True).collect()


def test_businesses_and_words(spark, folder, rows_of):
    path = put(folder, "business.json", '{"business_id": "b", "categories": null, "stars": 1.5}\n')
    assert read_businesses(spark, path).columns == ["business_id", "categories"]
    assert rows_of(read_words(spark, put(folder, "words", "the\n a\n"))) == [(" a",), ("the",)]


def test_report_is_one_object(spark, folder):
    df = spark.createDataFrame(
        [('u"1', "2018-01-01", "a b"), ('u"1', "2017-01-01", "b")], "user_id string, date string, text string"
    )
    write_report(exploration_report(df, 2018), f"{folder}/report")
    assert objects(f"{folder}/report") == [
        {"A": 2, "B": 1, "C": 1, "D": [{"user_id": 'u"1', "count": 2}], "E": ["b", "a"]}
    ]


def test_busy_files(spark, folder):
    df = spark.createDataFrame([("r1", "b1"), ("r2", "b1"), ("r3", "b2")], "review_id string, business_id string")
    found = busy_report(df, 1, n_partitions=4)
    write_busy_report(found.layout, found.result, folder + "/busy")
    layout = objects(f"{folder}/busy/layout")
    assert sorted(x["partition"] for x in layout) == [0, 1, 2, 3] and sum(x["rows"] for x in layout) == 3
    assert objects(f"{folder}/busy/result") == [{"business_id": "b1", "count": 2}]


def test_itemset_files(spark, folder):
    rows = [("b1", "x"), ("b1", "y"), ("b2", "x"), ("b2", "y"), ("b3", "z")]
    found = itemset_report(spark.createDataFrame(rows, "basket string, item string"), 2)
    write_itemsets(found.candidates, found.frequent, f"{folder}/sets")
    assert [o["items"] for o in objects(f"{folder}/sets/frequent/size=1")] == [["x"], ["y"]]
    assert objects(f"{folder}/sets/frequent/size=2") == [{"items": ["x", "y"], "support": 2}]
    named = [o["items"] for o in objects(f"{folder}/sets/candidates")]
    assert ["x", "y"] in named


def test_pairs_are_escaped(spark, folder):
    pairs = spark.createDataFrame([('a"b', "c\\", 0.5)], "b1 string, b2 string, sim double")
    write_similar_pairs(pairs, f"{folder}/pairs")
    assert objects(f"{folder}/pairs") == [{"b1": 'a"b', "b2": "c\\", "sim": 0.5}]


def test_header_of_one_part_only(spark, folder, rows_of):
    put(folder, "part-0.csv", "u,i\n1,a\n2,b\n")
    put(folder, "part-1.csv", "3,c\n4,d\n")
    want = [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")]
    assert rows_of(read_baskets(spark, folder, header="u,i")) == want
    assert rows_of(read_baskets(spark, folder)) == want


def test_category_report_is_one_object(spark, folder):
    report = spark.createDataFrame([("b", 2.0), ("c", 3.0), ("a", 2.0)], "category string, average double")
    write_category_report(report, f"{folder}/report")
    want = [{"category": c, "average": a} for c, a in (("c", 3.0), ("a", 2.0), ("b", 2.0))]
    assert objects(f"{folder}/report") == [{"result": want}]
