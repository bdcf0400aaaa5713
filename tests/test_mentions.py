"""Whom a text is about, on hand-made texts."""

from finloom.operators import mentions

TEXTS = {
    "cover": ("ANNUAL REPORT\nOmega Packaging Berhad 199001000001 (1-X)\nOmega Packaging Berhad\nregistrar Boardroom Services Berhad", ("omega packaging", 6, "199001000001")),
    "far down": ("Alpha Maju Berhad " + "word " * 700 + "Beta Jaya Bhd. " * 4, ("beta jaya", 4, None)),
    "tie": ("Beta Jaya Berhad and Alpha Maju Berhad", ("beta jaya", 3, None)),
    "running head": ("Overview About Gamma Sentosa Berhad; see Gamma Sentosa Berhad", ("gamma sentosa", 6, None)),
    "number too far": ("Delta Perkasa Berhad " + "word " * 30 + "200001000002", ("delta perkasa", 3, None)),
    "private": ("Rubber Works Sdn Bhd", None),
    "none": ("nothing here", None),
    "empty": ("", None),
    "null": (None, None),
}


def test_dominant_entities(spark):
    frame = spark.createDataFrame([(k, t) for k, (t, _) in TEXTS.items()], "doc string, text string")
    got = {r.doc: (r.key, r.weight, r.number) for r in mentions.dominant(frame).collect()}
    assert got == {k: want for k, (_, want) in TEXTS.items() if want}


def test_legal_forms_in_odd_places(spark):
    texts = [
        "Berhad", "Bhd. Alpha Berhad", "Alpha Berhad(200001000001)", "Alpha Berhadx Beta Bhd2", "Alpha Berhad " + "w " * 54 + "200001000001", "Alpha Berhad " + "w " * 53 + "200001000001", "Alpha Berhad " + "w " * 53 + "200001000001xy",
        "a" * 2999 + " Alpha Bhd", "Alpha  \n Maju\tBhd " * 600,
    ]
    found = mentions.mentions(spark.createDataFrame(list(enumerate(texts)), "doc int, text string")).orderBy("doc", "place").collect()
    got = [(r.doc, r.place, r.key, r.weight, r.number) for r in found if r.doc < 8]
    number = "200001000001"
    want = [(1, 11, "alpha", 3, None), (2, 6, "alpha", 3, number), (3, 19, "berhadx beta", 3, None), (4, 6, "alpha", 3, None), (5, 6, "alpha", 3, number), (6, 6, "alpha", 3, None), (7, 3006, "alpha", 1, None)]
    assert got == want
    assert [r.place for r in found if r.doc == 8] == [11 + 15 * i for i in range(600)]


def test_words_are_not_shuffled(spark):
    """Nothing but mentions is shuffled, once."""
    frame = spark.createDataFrame([(1, "Beta Jaya Berhad")], "doc int, text string")
    plan = mentions.dominant(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Window" not in plan
