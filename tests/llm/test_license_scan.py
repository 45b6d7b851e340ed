import re

from lakeward.llm import license_scan as ls


def plain(text):
    known = {s: i for i, s in ls.SENTENCES.items()}
    parts = re.split(r"[!?;\n\r]|\.(?![0-9])", text or "")
    ids = [known.get(re.sub("[^a-z0-9]+", " ", p.lower()).strip()) for p in parts]
    ids, names = [i for i in ids if i], []
    for name, sequence in ls.RULES:
        rest = iter(ids)
        if all(i in rest for i in sequence) and name not in names:
            names.append(name)
    return ids, names


def test_sequences_match_rules_in_order(spark):
    grant, as_is = ls.SENTENCES["mit-grant"], ls.SENTENCES["as-is"]
    texts = [
        None, "", "Nothing here. At all", "Text\nReleased under the MIT License.\nmore",
        "Licensed under the Apache License, Version 2.0.\nLICENSED under CC BY-NC 4.0.",
        f"{grant}. Other words. {as_is}!", f"{as_is}. {grant}.", f"{grant}. {grant}. {as_is}",
        "This work is licensed under the GNU General Public License, version 3." * 2,
        "x " * 20_000 + "\nReleased under the MIT License",
    ]
    rows = [(i, t, "a", "b") for i, t in enumerate(texts)]
    schema = "doc_id long, text string, licenses string, known string"
    docs = spark.createDataFrame([*rows, rows[3]], schema)
    found = ls.scan_licenses(docs).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        assert (r["sentence_ids"], r["licenses"]) == plain(texts[r["doc_id"]])
    assert ls.scan_licenses(docs.limit(0)).count() == 0
