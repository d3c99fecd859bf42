import random

from pyspark.sql import functions as F

from basketry.llm import language_id
from basketry.llm.queries import op5_language_id

SF = "/root/testdata/sf0.01"
WORDS = {
    "ab": ["tara", "milo", "kesu", "banto", "relig", "onda"],
    "cd": ["wrzyk", "choosh", "plint", "gruft", "schw", "tock"],
}


def table(spark, n=40):
    draw = random.Random(1)
    rows = [
        (i, " ".join(draw.choices(WORDS[lang], k=60)), lang) for i, lang in enumerate(["ab", "cd"] * (n // 2))
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_of_the_registered_query(spark):
    got = op5_language_id(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out")
    right = F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))
    n, accuracy, rejected = held.agg(F.count("*"), right, F.avg(F.col("rejected").cast("int"))).first()
    assert n > 200 and accuracy > 0.96 and rejected < 0.03
    assert got.count() == truth.count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_only_the_text_decides(spark):
    docs = table(spark)
    model = language_id.dictionaries(docs)
    lied = docs.withColumn("lang", F.lit("cd")).withColumn("doc_id", F.lit(3))
    first, second = (
        sorted(tuple(r) for r in language_id.identify(d, model).select("row.text", "lang_pred", "score").collect())
        for d in (docs, lied)
    )
    assert first == second
    assert language_id.identify(docs, model).where("row.lang <> lang_pred").count() == 0


def test_letters_decide_not_case_or_marks(spark):
    model = tuple(language_id.dictionaries(table(spark)).items())
    text = "tara milo kesu banto relig onda"
    assert language_id.classify(text, model)[:2] == language_id.classify("TARA!! Milo, kesu; banto 7 relig-ONDA", model)[:2]


def test_texts_without_letters_and_narrow_margins(spark):
    model = tuple(language_id.dictionaries(table(spark)).items())
    for text in (None, "", " \n", "12 34 _ !?"):
        assert language_id.classify(text, model) == ("und", 0.0, True)
    lang, score, rejected = language_id.classify("x", model)
    assert lang in ("ab", "cd") and 0 <= score <= 1 and rejected
    assert language_id.classify("tara milo", ()) == ("und", 0.0, True)


def test_the_sample_is_bounded_and_does_not_depend_on_the_order(spark, monkeypatch):
    docs = table(spark, 400)
    one = language_id.dictionaries(docs)
    assert one == language_id.dictionaries(docs.orderBy(F.desc("doc_id")).repartition(3))
    monkeypatch.setattr(language_id, "DICTIONARY_BYTES", 500)
    small = language_id.dictionaries(docs)
    assert all(len(v) < 500 + language_id.SAMPLE for v in small.values())


def test_a_language_of_long_texts_is_learned(spark):
    draw = random.Random(2)
    long = [(i, "123 " * 3000 + " ".join(draw.choices(WORDS["cd"], k=4000)), "cd") for i in range(40)]
    short = [(100 + i, " ".join(draw.choices(WORDS["ab"], k=30)), "ab") for i in range(40)]
    model = language_id.dictionaries(spark.createDataFrame(long + short, "doc_id long, text string, lang string"))
    assert set(model) == {"ab", "cd"}
    frozen = tuple(model.items())
    assert language_id.classify("wrzyk choosh plint gruft schw tock", frozen)[::2] == ("cd", False)
    assert language_id.classify(" ".join(WORDS["ab"]), frozen)[::2] == ("ab", False)


def test_numerals_and_signs_are_no_letters(spark):
    model = tuple(language_id.dictionaries(table(spark)).items())
    for text in ("½", "²", "①", "Ⅷ", "٣", "१२", "_", "😀", "́"):
        assert language_id.classify(text, model) == ("und", 0.0, True)
    for text in ("x½", "ß", "я", "中", "ª"):
        assert language_id.classify(text, model)[0] != "und"
    docs = spark.createDataFrame([(1, "½ ²", "ab"), (2, "tara", "cd")], "doc_id long, text string, lang string")
    assert set(language_id.dictionaries(docs)) == {"cd"}


def test_every_one_of_many_languages_can_be_predicted(spark):
    draw = random.Random(4)
    words = {f"l{i}": ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)] for i in range(300)}
    rows = [(i * 10 + j, " ".join(draw.choices(own, k=80)), lang) for i, (lang, own) in enumerate(words.items()) for j in range(3)]
    model = language_id.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(model) == set(words)
    assert sum(map(len, model.values())) <= language_id.MODEL_BYTES + 300 * language_id.SAMPLE
    frozen = tuple(model.items())
    language_id._compressors.cache_clear()
    assert all(language_id.classify(" ".join(words[x]), frozen)[0] == x for x in ("l0", "l150", "l299"))


def test_hard_rows(hard_docs, hard_rows, spark):
    model = language_id.dictionaries(hard_docs)
    got = language_id.identify(hard_docs, model)
    assert got.count() == len(hard_rows) and got.select("row.*").columns == hard_docs.columns
    of = {r["row"]["doc_id"]: r for r in got.where("row.doc_id is not null").collect()}
    assert of[5]["lang_pred"] == of[4]["lang_pred"] == of[8]["lang_pred"] == "und"
    assert of[7]["lang_pred"] == "en"
    kept = language_id.keep_identified(hard_docs, F.lit(True))
    assert kept.columns == hard_docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 2, 2, 3, 7, 10, 11]


def test_nothing(no_docs, hard_docs, hard_rows):
    assert language_id.dictionaries(no_docs) == {}
    assert language_id.identify(no_docs, {}).count() == 0
    assert language_id.identify(hard_docs, {}).where("lang_pred = 'und'").count() == len(hard_rows)
