import hashlib

import helpers as H
from pyspark.sql import functions as F

from ratings_spark.llm import licenses as L

MIT = dict((i, t) for i, t in L.KNOWN if len(t) > 500)["MIT"]


def one(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [tuple(r)[2:] for r in L.scan(docs).orderBy("doc_id").collect()]


def test_entire_texts_in_other_clothes(spark):
    changed = MIT.upper().replace("\n", "\r\n  * ").replace(",", ";").replace("SUBLICENSE", "sub-licence")
    owned = "Copyright (c) 2021 Some One\n\n(c) 2020-2022 Another, all rights reserved\n" + MIT + "\nAll rights reserved."
    cut = MIT[:-40]
    assert one(spark, MIT, changed, owned, cut, "copyright 2020", "") == [
        ("MIT", "", 0), ("MIT", "", 0), ("MIT", "", 0), (None, "", 0), (None, "", 0), (None, "", 0)]


def test_notices(spark):
    text = "Some words.\n  RELEASED under the MIT Licence!\nmore\nLicensed under CC BY-NC 4.0\nLicensed under CC BY-NC 4.0."
    assert one(spark, text, "Licensed under the Apache License, Version 2.0.",
               "It is licensed under the Apache License, Version 2.0.") == [
        (None, "CC-BY-NC-4.0,MIT", 3), ("Apache-2.0", "Apache-2.0", 1), (None, "", 0)]


def test_a_line_is_normalised_as_a_text(spark):
    lines = ["A, b -- C licence", " x  sub license", "sub", "License z", "© 2020 q", "Copyright notice"]
    rows = spark.createDataFrame([(x,) for x in lines], "t string")
    alone = [r[0] for r in rows.select(L.canonical(F.col("t"))).collect()]
    assert alone == ["a b c license", "x sublicense", "sub", "license z", "", "copyright notice"]


def test_equals_sql(spark):
    got = L.scan(spark.read.parquet(f"{H.SF}/documents.parquet"))
    want = H.duck().execute(L.oracle())
    names = [d[0] for d in want.description]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert H.rows_of(got, *names) == sorted(want.fetchall(), key=key)


def test_registry_table_and_digest(spark):
    known = spark.createDataFrame([("b", "Words, here!"), ("a", "words here"), ("c", None), ("d", "--")],
                                  "license_id string, text string")
    table = L.registry(spark, known)
    assert [tuple(r) for r in table.collect()] == [(hashlib.sha256(b"words here").hexdigest(), "a")]
    docs = H.odd(spark, "digest", "license_id", "rid", "unit")
    assert L.scan(docs, table).count() == len(H.ODD)


def test_empty(spark):
    assert L.scan(H.nothing(spark)).collect() == []
    none = spark.createDataFrame([], "license_id string, text string")
    assert L.scan(H.odd(spark), L.registry(spark, none)).where("license_id IS NOT NULL").count() == 0


def test_entire_texts_headers_and_spdx_lines_of_common_licences(spark):
    editions = {f.stem: f.read_text() for f in sorted(L.FOLDER.glob("*.txt")) if f.stem != "spdx_ids"}
    files = {name: text for name, text in editions.items() if "~" not in name}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0",
            "CC0-1.0"} <= set(files)
    got = one(spark, *editions.values())
    assert [r[0] for r in got] == [name.split("~")[0] for name in editions]
    apache = files["Apache-2.0"]
    filled = apache.replace("[yyyy] [name of copyright owner]", "2020 Some One")
    bare = apache[:apache.index("   END OF TERMS")]
    cut = files["GPL-3.0"].replace("warranty", "", 1)
    assert [r[0] for r in one(spark, filled, bare, cut)] == ["Apache-2.0", "Apache-2.0", None]

    # Headers as they stand above code: MPL's own exhibit, and Apache's own appendix.
    header = "# " + apache[apache.index("   Licensed under the Apache"):].replace("\n", "\n# ")
    mpl = files["MPL-2.0"]
    mpl = mpl[mpl.index("  This Source Code Form is subject"):mpl.index("If it is not possible")]
    gpl = files["GPL-3.0"]
    gpl = gpl[gpl.index("    This program is free software: you can"):gpl.index("Also add information on how")]
    assert one(spark, "# Copyright 2020 Some One\n" + header, mpl, gpl) == [
        ("Apache-2.0", "Apache-2.0", 1), ("MPL-2.0", "MPL-2.0", 1), ("GPL-3.0-or-later", "", 0)]
    assert one(spark, header + "\nimport os", mpl + "\nint main()") == [(None, "Apache-2.0", 1), (None, "MPL-2.0", 1)]

    assert one(spark, "// SPDX-License-Identifier: GPL-2.0-only\nint x;", "# SPDX-License-Identifier: MIT OR Apache-2.0",
               "/* SPDX-License-Identifier: EUPL-1.2 */\nx", "SPDX-License-Identifier: Not-A-Licence") == [
        (None, "GPL-2.0-only", 1), ("MIT OR Apache-2.0", "MIT OR Apache-2.0", 1), (None, "EUPL-1.2", 1), (None, "", 0)]


def test_known_texts_name_one_licence(spark):
    rows = spark.createDataFrame(list(L.KNOWN), "license_id string, text string")
    many = (rows.groupBy(L.digest(L.canonical(F.col("text"))).alias("d"))
            .agg(F.collect_set("license_id").alias("ids")).where("size(ids) > 1"))
    assert many.collect() == []
