from lakestrata.llm.decontamination import contamination

FILL = " ".join(f"filler{k}" for k in range(600))


def found(spark, text, item):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return contamination(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()


def test_leak_after_the_question_alone(spark):
    question = " ".join(f"q{k}" for k in range(40))
    answer = " ".join(f"a{k}" for k in range(10))
    edited = question.replace("q5 ", "other ").replace("q20 ", "changed ").replace("q33 ", "new ")
    text = f"{question}\nsomething else {FILL} {edited}\n{answer} {FILL}"
    rows = found(spark, text, f"{question}\n{answer}")
    assert len(rows) == 1 and rows[0]["first_word"] > 400 and rows[0]["answer_overlap"] == 1.0
    assert not found(spark, f"{question}\nsomething else {FILL}", f"{question}\n{answer}")


def test_leak_after_its_first_segment(spark):
    words = [f"i{k}" for k in range(150)]
    item = " ".join(words[:130]) + "\n" + " ".join(words[130:])
    text = " ".join(words[:50]) + f" {FILL} {item} {FILL}"
    rows = found(spark, text, item)
    assert len(rows) == 1 and rows[0]["score"] > 0.99 and rows[0]["first_word"] > 400
