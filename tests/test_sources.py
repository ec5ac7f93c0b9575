import pytest
from pyspark.sql import functions as F

from loanweave.operators import covers, encoders, factorisation as cmf
from loanweave.operators.catalog import clean_items
from loanweave.plans import features, training
from loanweave.sources import tables

ITEMS = [
    ('A "quoted"; title /', "Hugo, Victor, 1802-1885", "9782070368228", "Seuil", "Roman ; Été", 0),
    ("Line\nbreak", None, None, None, None, 1),
    ("Plain", "Eco", "2070368228", "Seuil", "roman", 2),
]


def test_csv_round_trip(spark, tmp_path):
    items = spark.createDataFrame(ITEMS, tables.ITEMS)
    tables.write_csv(items, str(tmp_path / "items"))
    back = tables.read_items(spark, str(tmp_path / "items"))
    assert sorted(map(tuple, back.collect()), key=lambda r: r[-1]) == ITEMS


def test_lists_become_text(spark, tmp_path):
    frame = spark.createDataFrame([(1, ["a", "b"])], "i long, tags array<string>")
    tables.write_csv(frame, str(tmp_path / "lists"))
    assert spark.read.option("header", True).csv(str(tmp_path / "lists")).first().tags == "a; b"


def test_wrong_columns_and_nulls(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "u long, i long").write.option("header", True).csv(str(tmp_path / "short"))
    with pytest.raises(tables.SchemaMismatch):
        tables.read_interactions(spark, str(tmp_path / "short"))
    spark.createDataFrame([(1, 2, None)], "u long, i long, t long").write.parquet(str(tmp_path / "nulls"))
    with pytest.raises(tables.SchemaMismatch):
        tables.read_interactions(spark, str(tmp_path / "nulls"), "parquet")


def test_missing_files(spark, tmp_path):
    loans, items, reason = tables.read_both(spark, str(tmp_path / "no"), str(tmp_path / "no"))
    assert loans is None and items is None and reason
    assert tables.read_cover_cache(spark, str(tmp_path / "no")).count() == 0
    assert tables.read_model(spark, str(tmp_path / "no")) is None
    assert training.load_factors(spark, str(tmp_path / "no")) is None


def test_named_tables(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2, 3)], "u long, i long, t long")
    tables.write_table(frame, str(tmp_path), "train")
    assert tables.read_table(spark, str(tmp_path), "train").collect() == frame.collect()
    with pytest.raises(ValueError):
        tables.write_table(frame, str(tmp_path), "other")


def test_vocabulary_keeps_accents(spark, tmp_path):
    vocabulary = spark.createDataFrame([("bande dessinée", 0), ("größe", 1)], "subject string, subject_idx long")
    tables.write_vocabulary(vocabulary, str(tmp_path / "vocab"))
    back = tables.read_vocabulary(spark, str(tmp_path / "vocab")).orderBy("subject_idx")
    assert back.collect() == vocabulary.orderBy("subject_idx").collect()


def test_cover_cache(spark, tmp_path):
    cache = spark.createDataFrame([(1, "x", "u1", "M"), (2, "y", "u2", "S")], tables.COVERS)
    tables.write_csv(cache, str(tmp_path / "cache"))
    read = tables.read_cover_cache(spark, str(tmp_path / "cache"))
    updates = spark.createDataFrame([(1, "z", "u9", "M"), (3, "w", "u3", "M")], tables.COVERS)
    merged = covers.upsert(read, updates)
    assert {tuple(r) for r in merged.collect()} == {(1, "z", "u9", "M"), (2, "y", "u2", "S"), (3, "w", "u3", "M")}
    assert covers.cleared(merged).count() == 0


def test_encoder_and_unseen_values(spark, tmp_path):
    values = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "name string")
    fitted = encoders.fit_categories(values, "name", 2, "rare")
    tables.write_encoder(fitted, str(tmp_path / "encoder"))
    encoder = tables.read_encoder(spark, str(tmp_path / "encoder"))
    new = spark.createDataFrame([("a",), ("b",), ("new",)], "name string")
    coded = {r.name: r.code for r in encoders.apply_categories(new, "name", encoder, "rare", "code").collect()}
    assert coded == {"a": 0, "b": 1, "new": 1}
    all_known = encoders.fit_categories(values, "name", 1, "rare")
    coded = {r.name: r.code for r in encoders.apply_categories(new, "name", all_known, "rare", "code").collect()}
    assert coded == {"a": 0, "b": 1, "new": None}


def test_model_round_trip(spark, tmp_path):
    loans = spark.createDataFrame([(u, (u * k) % 3, k) for u in range(6) for k in range(1, 5)], "u long, i long, t long")
    items = spark.createDataFrame(ITEMS, tables.ITEMS)
    config = cmf.CMFConfig(factors=3, iterations=1)
    lines, model = training.train_and_submit(loans, items, config)
    assert lines.count() == 6
    training.save(model, config, str(tmp_path / "model"), spark)
    settings, bundle = tables.read_model(spark, str(tmp_path / "model"))
    assert settings["config"]["factors"] == 3 and "items" in bundle
    users, stored = training.load_factors(spark, str(tmp_path / "model"))
    assert users.count() == model.factors.users.count()
    assert stored.count() == model.factors.sides.filter(F.col("side") == "item").count()


def tagged(spark, rows):
    return spark.createDataFrame(rows, "i long, subjects_list array<string>")


def test_tfidf_edge_cases(spark):
    vocabulary = spark.createDataFrame([("rock", 0), ("jazz", 1)], "subject string, subject_idx long")
    assert encoders.subject_tfidf(tagged(spark, [(0, []), (1, [])]), vocabulary).count() == 0
    assert encoders.subject_tfidf(tagged(spark, [(0, ["unheard-of"])]), vocabulary).count() == 0
    mixed = encoders.subject_tfidf(tagged(spark, [(0, ["rock", "unheard-of"])]), vocabulary).collect()
    assert [(r.subject_idx, round(r.weight, 9)) for r in mixed] == [(0, 1.0)]
    both = encoders.subject_tfidf(tagged(spark, [(5, ["rock", "jazz"]), (2, ["rock"])]), vocabulary).collect()
    assert {r.i for r in both} == {2, 5}
    assert abs(sum(r.weight**2 for r in both if r.i == 5) - 1) < 1e-12


def test_vocabulary_limits(spark):
    rows = [(n, ["a", "b"] if n < 4 else ["a"]) for n in range(8)] + [(9, ["c"])]
    kept = encoders.subject_vocabulary(tagged(spark, rows), min_freq=2, max_features=5).orderBy("subject_idx").collect()
    assert [(r.subject, r.subject_idx, r.n) for r in kept] == [("a", 0, 8), ("b", 1, 4)]
    top = encoders.subject_vocabulary(tagged(spark, rows), min_freq=1, max_features=1).collect()
    assert [r.subject for r in top] == ["a"]


def test_catalogue_without_tfidf(spark):
    loans = spark.createDataFrame([(1, 0, 1), (2, 2, 1)], "u long, i long, t long")
    built = features.build_catalogue(spark.createDataFrame(ITEMS, tables.ITEMS), loans, min_freq=1, tfidf=False)
    assert {r.weight for r in built.subjects.collect()} == {1.0}
    assert clean_items(spark.createDataFrame(ITEMS, tables.ITEMS), loans).count() == 2
