from lakeloom.llm import licenses as li


def test_rows_of_one_key_do_not_hide_each_other(spark):
    whole = li.TEMPLATES["mit-header"]
    words = whole.split()
    altered = []
    for at in range(4, len(words) - 3, 2):  # meets bands, but holds less than 0.8 of the shingles
        altered.append(" ".join([*words[:at], "x", "y", *words[at + 2:len(words) - 1]]))
    texts = [*altered, whole, *altered]
    for key in (None, 7):
        rows = [(key, t) for t in texts]
        frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        for given in (frame, spark.createDataFrame(rows[::-1], frame.schema).coalesce(1)):
            got = [r for r in li.find_licenses(given).collect() if r.template == "mit-header"]
            assert [(r.doc_id, r.containment, r.first_word) for r in got] == [(key, 1.0, 0)]
