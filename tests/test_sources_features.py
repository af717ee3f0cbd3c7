import gzip
import os

import pytest
from pyspark.sql import functions as F

from shoplens.functions.text import emotion_score, keyword_flag, translate_category
from shoplens.operators.features import build_feature_table, prepare_items
from shoplens.schema import FEMALE_WORDS, MALE_WORDS, REQUIRED_COLUMNS
from shoplens.sources import driver_tables as dt
from shoplens.sources.files import load_structured_dataset, parse_meta, read_ratings

from .conftest import SF


def test_text_features(spark):
    df = spark.createDataFrame([("Women's Leather Boot", "Clothing"), ("Gold ring new soft", "Weird"),
                                ("", None), ("Baby string", "Sports &amp; Outdoors")], "t string, raw string")
    got = df.select(translate_category(F.col("raw"), F.col("t")).alias("c"), emotion_score(F.col("t")).alias("e"),
                    keyword_flag(F.col("t"), FEMALE_WORDS).alias("f"), keyword_flag(F.col("t"), MALE_WORDS).alias("m")).collect()
    assert [r["c"] for r in got] == ["服饰", "珠宝配饰", "服饰", "运动户外"]
    assert got[0]["f"] == 1 and got[0]["m"] == 1  # "men" inside "women"
    assert got[1]["e"] == 0.75 and got[2]["e"] == 0.25


def test_load_structured_rules(spark, tmpdir_run):
    header = ",".join(REQUIRED_COLUMNS + ["extra"])
    good = ["U1", "I1"] + ["1"] * 10 + ["服饰"] + ["1"] * 19 + ["x"]
    bad_num = list(good); bad_num[2] = "abc"
    na_num = list(good); na_num[4] = "NA"
    no_cat = list(good); no_cat[12] = ""
    path = os.path.join(tmpdir_run, "in.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(header + "\n" + "\n".join(",".join(r) for r in [good, bad_num, na_num, no_cat]) + "\n")
    df = load_structured_dataset(spark, path)
    assert df.columns == REQUIRED_COLUMNS
    rows = df.collect()
    assert len(rows) == 2 and sorted(r["category"] for r in rows) == ["nan", "服饰"]
    with open(os.path.join(tmpdir_run, "bad.csv"), "w") as fh:
        fh.write("user_id,item_id\nU1,I1\n")
    with pytest.raises(ValueError, match="no column"):
        load_structured_dataset(spark, os.path.join(tmpdir_run, "bad.csv"))


def test_meta_literals_and_item_rules(spark, tmpdir_run):
    lines = [
        "{'asin': 'A1', 'title': u'Ladies watch', 'price': 10.0, 'imUrl': 'u', 'salesRank': {'Watches': 3}}",
        "{'asin': 'A1', 'title': 'dup later', 'price': 12.0}",
        "{'asin': 'A2', 'title': '', 'price': 5.0}",
        "{'asin': 'A3', 'title': 'x', 'price': 'abc'}",
        "{'asin': 'A4', 'title': 'Neg', 'price': -1}",
        "{'asin': 'A5', 'title': 'Shoe \"max\"', 'price': 20, 'related': {'also_bought': ['a', 'b']}}",
        "{'title': 'no asin', 'price': 3}",
    ]
    path = os.path.join(tmpdir_run, "meta.json.gz")
    with gzip.open(path, "wt", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    items = prepare_items(parse_meta(spark, path)).collect()
    got = {r["item_id"]: r for r in items}
    assert sorted(got) == ["A1", "A5"]
    assert got["A1"]["title"] == "Ladies watch" and got["A1"]["category"] == "腕表"
    assert got["A5"]["related_count"] == 2 and got["A5"]["category"] == "服饰"  # no salesRank -> default raw category


def test_feature_build_smoke_and_guard(spark):
    ft = build_feature_table(dt.ratings(spark, SF), dt.items(spark, SF))
    assert ft.columns == REQUIRED_COLUMNS
    assert ft.count() == 6000
    with pytest.raises(ValueError, match="usable rows"):
        build_feature_table(dt.ratings(spark, SF), dt.items(spark, SF), min_rows=10**7)


def test_ratings_reader(spark, tmpdir_run):
    path = os.path.join(tmpdir_run, "r.csv")
    with open(path, "w") as fh:
        fh.write("U1,0007,5,0\nU1,0008,4,86400\n")
    r = read_ratings(spark, path).collect()
    assert r[0]["item_id"] == "0007" and r[1]["rating"] == 4.0


def test_star_sample_with_bom(spark, tmpdir_run):
    from shoplens.sources.files import STAR_SCHEMAS, read_star, write_table
    from shoplens.sources.paging import sample_star

    bom = "﻿"
    with open(os.path.join(tmpdir_run, "transactions_sample.csv"), "w", encoding="utf-8") as fh:
        fh.write(bom + "t_dat,customer_id,article_id,price,sales_channel_id\n")
        for i in range(30):
            fh.write(f"2020-09-01,c{i % 7},0{100 + i % 11},0.05,{1 + i % 2}\n")
    with open(os.path.join(tmpdir_run, "customers_sample.csv"), "w", encoding="utf-8") as fh:
        fh.write(bom + "customer_id,FN,Active,club_member_status,fashion_news_frequency,age,postal_code\n")
        for i in range(10):
            fh.write(f"c{i},1.0,,ACTIVE,NONE,{20 + i},p{i}\n")
    with open(os.path.join(tmpdir_run, "articles_sample.csv"), "w", encoding="utf-8") as fh:
        names = STAR_SCHEMAS["articles"].replace(" string", "").replace(" int", "").replace(", ", ",")
        fh.write(bom + names + "\n0100,1,a" + "," * 21 + ',"a ""soft"", warm\nthing"\n0105,2,b' + "," * 22 + "\n")
    star = read_star(spark, tmpdir_run)
    assert star["transactions"].columns[0] == "t_dat" and star["transactions"].count() == 30
    assert star["articles"].first()["article_id"] == "0100"
    assert [r["detail_desc"] for r in star["articles"].orderBy("article_id").collect()] == ['a "soft", warm\nthing', None]
    facts, dims = sample_star(star["transactions"], ["t_dat", "customer_id", "article_id"], star["customers"],
                              "customer_id", "customer_id", n_facts=20, n_ids=3)
    assert facts.count() == 20 and dims.count() == 3  # the semi join is not empty
    out = os.path.join(tmpdir_run, "out")
    write_table(dims, out, fmt="csv")
    assert spark.read.option("header", True).csv(out).count() == 3


def test_candidate_pairs_hold_the_whole_pool(spark):
    from shoplens.operators.recommend import build_candidate_pairs, item_pool
    from shoplens.plans.catalog import feature_table

    f = feature_table(spark, SF)
    users, pool = f.dropDuplicates(["user_id"]).limit(4), item_pool(f, 150)
    pairs = build_candidate_pairs(users, pool, None)
    assert pairs.count() == 4 * pool.count() == pairs.select("user_id", "item_id").distinct().count()
