import json

import yaml

from tokenloom.operators import collate


def frames(spark, frequencies, similar):
    return (
        spark.createDataFrame(frequencies, "word string, token string, frequency long"),
        spark.createDataFrame(similar, "token string, similar array<string>"),
    )


def test_all_three_cases(spark):
    f, s = frames(
        spark,
        [("harbour", "88", 4), ("alone", "7", 3), ("", "9", 1)],
        [("88", ["elm", "ash"]), ("8", ["88"])],
    )
    got = {r.token: (r.word, r.frequency, r.similar) for r in collate.collate(f, s).collect()}
    assert got == {
        "88": ("harbour", 4, ["elm", "ash"]),
        "7": ("alone", 3, None),
        "8": ("N/A", 0, ["88"]),
        "9": ("N/A", 1, None),
    }


def test_repeated_tokens_fold_to_one_record(spark):
    f, s = frames(spark, [("a", "1", 2), ("b", "1", 5)], [("1", ["x"]), ("1", ["y", "z"])])
    row = collate.collate(f, s).first()
    assert (row.word, row.frequency, row.similar) == ("b", 5, ["x", "y", "z"])


def test_reports_parse_back(spark):
    f, s = frames(spark, [('q"uo\\te', "1", 2), ("null", "2", 1)], [("1", ["2", "N/A"])])
    collated = collate.collate(f, s)
    parsed = {r.token: yaml.safe_load(r.text) for r in collate.report_yaml(collated).collect()}
    assert parsed["1"] == {"word": 'q"uo\\te', "intToken": "1", "frequency": 2, "semanticallySimilarTokens": ["2", "N/A"]}
    assert parsed["2"] == {"word": "null", "intToken": "2", "frequency": 1, "semanticallySimilarTokens": "N/A"}
    as_json = {r.token: json.loads(r.text) for r in collate.report_json(collated).collect()}
    assert as_json["1"] == parsed["1"]


def test_control_characters_are_escaped(spark):
    odd = "".join(map(chr, (*range(0x20), 0x7F, 0x85, 0x9F, 0xA0, 0x2028, 0x2029, 0xFEFF))) + 'a"\\é𝄞'
    f, s = frames(spark, [(odd, "1", 2), ("plain", odd, 1)], [("1", [odd, "x"])])
    collated = collate.collate(f, s)
    texts = {r.token: r.text for r in collate.report_yaml(collated).collect()}
    assert all(ch.isprintable() or ch in "\n\u00a0" for text in texts.values() for ch in text)
    assert yaml.safe_load(texts["1"]) == {"word": odd, "intToken": "1", "frequency": 2, "semanticallySimilarTokens": [odd, "x"]}
    assert yaml.safe_load(texts[odd])["intToken"] == odd
    assert json.loads(collate.report_json(collated).filter("token = '1'").first().text)["word"] == odd


def test_tagged_union(spark):
    f, s = frames(spark, [("w", "1", 2)], [("1", ["2", "3"])])
    got = sorted(map(tuple, collate.tagged_union(f, s).collect()))
    assert got == [("semantic_similarity", "1", "2,3"), ("tokenization", "1", "w\t2")]
