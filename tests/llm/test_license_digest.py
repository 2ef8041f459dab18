import hashlib

from cohortlens.llm.license_digest import FILES, LICENSES, license_matches


def test_known_texts_in_other_dress(spark, make_docs):
    mit = LICENSES["MIT"]
    rows = [(1, mit), (2, "  Copyright (c) 2001 Some One\n// (C) another\n" + mit.upper().replace(" ", "\n * ")),
            (3, mit.replace("sublicense", "sublicence").replace('"', "“")), (4, mit + " more"), (5, None), (6, ""),
            (7, "!!!"), (8, "Released under the MIT Licence"), (8, "Released under the MIT Licence"), (None, LICENSES["ISC"]),
            (9, "é" * 200_000), (10, "Released under the MIT License Ж")]
    got = sorted(((r.doc_id, r.license) for r in license_matches(make_docs(rows)).collect()), key=repr)
    assert got == sorted([(1, "MIT"), (2, "MIT"), (3, "MIT"), (4, None), (5, None), (6, None), (7, None), (8, "MIT notice"),
                          (8, "MIT notice"), (None, "ISC"), (9, None), (10, None)], key=repr)


def test_digest_is_of_the_canonical_form(spark, make_docs):
    got = license_matches(make_docs([(1, " The LICENCE -- of\nÄ ")]), {"one": "the license of Ä"}).first()
    assert got.license == "one" and got.canonical_sha256 == hashlib.sha256("the license of Ä".encode()).hexdigest()


def test_empty_table(make_docs):
    assert license_matches(make_docs([])).collect() == []


def test_usual_headed_files_and_long_licences(spark, make_docs):
    text = lambda name: (FILES / f"{name}.txt").read_text()
    gpl, apache = text("GPL-3.0"), text("Apache-2.0")
    terms = apache[:apache.index("APPENDIX")] if "APPENDIX" in apache else apache
    cases = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + LICENSES["MIT"]),
        ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2014-2016 Some One <a@b.c>\nCopyright (c) 2017 Other\n\n" + LICENSES["MIT"]),
        ("MIT", "(The MIT License)\n\n" + LICENSES["MIT"]), ("ISC", "ISC License\n\nCopyright (c) 2004 X\n\n" + LICENSES["ISC"]),
        ("ISC", "The ISC License\n\n" + LICENSES["ISC"]), ("Zlib", "zlib License\n\n(C) 1995 X\n\n" + LICENSES["Zlib"]),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2019, X\nAll rights reserved.\n\n" + text("BSD-3-Clause").split("\n", 1)[1]),
        ("BSD-2-Clause", "Copyright 2019 X\n" + text("BSD-2-Clause").split("\n", 1)[1]),
        ("GPL-3.0", gpl), ("GPL-3.0", gpl[:gpl.index("How to Apply These Terms to Your")]), ("GPL-3.0", gpl.split("\n", 2)[2]),
        ("Apache-2.0", apache), ("Apache-2.0", terms), ("Apache-2.0", apache[:apache.index("END OF TERMS")]),
        *((f.stem, f.read_text()) for f in sorted(FILES.glob("*.txt"))),
        (None, "MIT License"), (None, "MIT License\n\nMIT License\n\n" + LICENSES["MIT"]), (None, gpl + " more"),
    ]
    got = {r.doc_id: r.license for r in license_matches(make_docs([(i, t) for i, (_, t) in enumerate(cases)])).collect()}
    assert got == {i: name for i, (name, _) in enumerate(cases)}


def test_notices_without_year_and_foreign_line_ends(make_docs):
    mit, bsd = LICENSES["MIT"], (FILES / "BSD-2-Clause.txt").read_text().split("\n", 1)[1]
    cases = [("MIT", "Copyright Jane Doe\n\n" + mit), ("MIT", "# Copyright: The Foo Authors\nCopyright Foo Inc. and others\n" + mit),
             ("MIT", chr(0xFEFF) + "MIT License\r\n\r\nCopyright (c) 2020 X\r\n\r\n" + mit.replace("\n", "\r\n")),
             ("MIT", "MIT License\r\rCopyright X\r\r" + mit.replace("\n", "\r")), ("MIT", "// SPDX-License-Identifier: MIT\n" + mit),
             ("BSD-2-Clause", "Copyright Jane Doe\n" + bsd), ("ISC", LICENSES["ISC"].replace("and/or", "and")),
             ("Unlicense", "The Unlicense\n\n" + LICENSES["Unlicense"]), (None, "SPDX-License-Identifier: MIT"),
             (None, mit.replace("The above copyright notice", "\nCopyright Notice and")), (None, "Copyright Jane Doe")]
    got = {r.doc_id: r.license for r in license_matches(make_docs([(i, t) for i, (_, t) in enumerate(cases)])).collect()}
    assert got == {i: name for i, (name, _) in enumerate(cases)}


def test_sql_knows_all_texts(make_docs):
    import duckdb

    from cohortlens.llm.license_digest import known_texts
    from cohortlens.llm.queries import ORACLE
    dress = [lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: chr(0xFEFF) + "Copyright Some One\n" + t, lambda t: t + "\n\n ** "]
    docs = make_docs([(i, dress[i % 4](t)) for i, (_, t) in enumerate(known_texts())] + [(1000, None), (1001, "x"), (1002, "")])
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    want = con.execute(f"SELECT doc_id, canonical_sha256, license FROM ({ORACLE['op5_license_digest']})").fetchall()
    got = sorted(map(tuple, license_matches(docs).select("doc_id", "canonical_sha256", "license").collect()))
    assert got == sorted(want) and sum(r[2] is not None for r in want) == len(known_texts())
