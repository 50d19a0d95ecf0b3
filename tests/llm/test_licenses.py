import hashlib
import textwrap

from tapeworks.llm import licenses

MIT, APACHE = licenses.KNOWN_TEXTS["MIT"], licenses.KNOWN_TEXTS["Apache-2.0"]


def report(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, digest int").repartition(2)
    return {r.doc_id: r for r in licenses.license_report(df).collect()}


def test_whole_texts_and_notices(spark):
    loud = "  Copyright (c) 2024 Somebody\n\n" + MIT.upper().replace(", ", " ;\t ") + " !!"
    british = licenses.KNOWN_TEXTS["Apache-2.0-header"].replace("License", "Licence").replace("http:", "https:")
    got = report(spark, [
        (0, MIT), (1, loud), (2, british), (3, "All of it.\n" + MIT), (4, "prose\n" + APACHE.lower() + "\nmore prose"),
        (5, "Released under the MIT licence\nLicensed under CC BY-NC 4.0!\n" + APACHE), (6, "a licence of my own")])
    assert [got[i].license_id for i in range(7)] == ["MIT", "MIT", "Apache-2.0-header", None, None, None, None]
    assert got[4].notices == "Apache-2.0" and got[5].notices == "Apache-2.0,CC-BY-NC-4.0,MIT-notice" and got[6].notices == ""


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (2, "!!! ..."), (3, "word " * 100000), (4, "© 2020 all of us"), (5, APACHE), (5, APACHE)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.license_report(df).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == 7 and {r.digest for r in got if r.doc_id in (None, 1, 2, 4)} == {empty}
    assert [r.license_id for r in got if r.doc_id == 5] == ["Apache-2.0"] * 2
    assert all(r.license_id is None for r in got if r.doc_id != 5)
    assert licenses.license_report(df.limit(0)).collect() == []


def test_own_table_of_licenses(spark):
    known = spark.createDataFrame([("B", "My Licence"), ("A", "my license!"), (None, "x"), ("C", None), ("D", "")],
                                  "license_id string, text string")
    docs = spark.createDataFrame([(1, "MY LICENSE"), (2, "x")], "doc_id long, text string")
    assert {r.doc_id: r.license_id for r in licenses.scan(docs, known, ["doc_id"]).collect()} == {1: "A", 2: None}


def test_repeated_words_are_all_respelt(spark):
    got = report(spark, [(1, "licence licence licence"), (2, "license license license")])
    assert got[1].digest == got[2].digest


def test_known_texts_match_however_their_lines_are_broken(spark):
    made = [(k, w) for k in licenses.KNOWN_TEXTS for w in (*range(20, 141, 4), 72, 78, 100000)]
    rows = [(i, "Copyright (c) 2024 Some Body\n\n" + textwrap.fill(
        " ".join(licenses.KNOWN_TEXTS[k].split()), w, break_long_words=False, break_on_hyphens=False))
            for i, (k, w) in enumerate(made)]
    got = report(spark, rows)
    assert [m for i, m in enumerate(made) if got[i].license_id != m[0]] == []


def test_only_real_copyright_lines_go(spark):
    gone = ["Copyright 2020 A", "copyright (c) 1999-2004, A", "(C) 2020 A", "(c) Copyright A B", "© A", "Copyright: A Inc.",
            "Copyright The A Authors", "Copyright <YEAR> <COPYRIGHT HOLDER>", " * Copyright [yyyy] [name of owner]", "(c) Acme Inc.",
            "All rights reserved.", "COPYRIGHT ACME", "Copyright © 2020 A"]
    stay = ["COPYRIGHT HOLDERS BE LIABLE", "copyright notice, this list", "copyright owner or entity", "copyrighted works",
            "copyright", "copyright, patent and trademark", "(c) You must retain, in the Source form", "(c) copyright notices stay"]
    got = report(spark, [(i, "要約\n\n" + x) for i, x in enumerate(gone + stay)])
    bare = hashlib.sha256("要約".encode()).hexdigest()
    assert [x for i, x in enumerate(gone + stay) if (got[i].digest == bare) != (x in gone)] == []


def test_titles_go_and_sentences_stay(spark):
    titles = ["MIT License", "The MIT License (MIT)", "# MIT Licence:", "ISC License", "BSD 2-Clause License", "Some Own License, Version 2.1",
              "  === The \"Free\" License v3 ===".replace("=", "*")]
    rows = [(i, f"{t}\n\nCopyright (c) 2024 A\n\n{MIT}") for i, t in enumerate(titles[:6])]
    stay = ["Licensed under this license", "Released under the MIT License", "See the license", "A license"]
    rows += [(100 + i, f"{t}\n{MIT}") for i, t in enumerate(stay[:3])] + [(200, "MIT License"), (201, "MIT License\n\n"), (202, "mit license x")]
    got = report(spark, rows)
    assert [got[i].license_id for i in range(6)] == ["MIT"] * 6
    assert [got[100 + i].license_id for i in range(3)] == [None] * 3
    assert got[200].digest == got[201].digest == hashlib.sha256(b"mit license").hexdigest() != got[202].digest


def test_own_table_without_usual_words(spark):
    known = spark.createDataFrame([("PD", "Dedicated to the public domain."), ("SP", "SPDX: GPL-3.0"), ("S", "Sub licence at will")],
                                  "license_id string, text string")
    docs = spark.createDataFrame([(1, "x\n  dedicated to the PUBLIC domain!\nspdx gpl 3.0"), (2, "(sublicense) at will\nother"),
                                  (3, "Sub-Licence at will")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, known, ["doc_id"]).collect()}
    assert got[1].notices == "PD,SP" and got[2].notices == "S" and (got[3].license_id, got[3].notices) == ("S", "S")


def test_table_from_license_files(spark, tmp_path):
    (tmp_path / "MIT.txt").write_text("MIT License\n\nCopyright (c) <year> <holders>\n\n" + MIT)
    (tmp_path / "Own-1.0").write_text("OWN LICENSE\nVersion 1, 29 June 2007\n\nEveryone may copy it.")
    known = licenses.known_from_files(spark, str(tmp_path))
    docs = spark.createDataFrame([(1, MIT.lower()), (2, "Own License\n version 1, 29 JUNE 2007\neveryone may copy it"), (3, "version 1")],
                                 "doc_id long, text string")
    assert {r.doc_id: r.license_id for r in licenses.scan(docs, known, ["doc_id"]).collect()} == {1: "MIT", 2: "Own-1.0", 3: None}


def test_sql_equals_the_scan(spark):
    """The oracle on texts where its rules matter: copyright lines, titles, spellings."""
    import duckdb
    rows = [(i, t) for i, t in enumerate([
        "The MIT License (MIT)\nCopyright Acme Inc.\n" + MIT, "Copyright notice\n" + MIT, "(c) Acme Inc.\n" + APACHE, "(c) you must\n" + APACHE,
        "COPYRIGHT HOLDERS BE\n" + APACHE, "licensed under a license\n" + APACHE, "Apache License, Version 2.0\n" + APACHE, None, "", "x\n" + APACHE,
        "copyright 2020\nReleased under the MIT licence"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    documents = df.toPandas()  # noqa: F841  (named in the SQL)
    want = con.execute(licenses.ORACLE).fetchall()
    cols = [d[0] for d in con.description]
    assert sorted(map(tuple, licenses.license_report(df).select(*cols).collect()), key=str) == sorted(want, key=str)
