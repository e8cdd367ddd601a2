"""Line dedup, mixing and licence scan: fixed cases and plain recomputation."""

import math

from pyspark.sql import functions as F

from textlens.llm import licenses, mixing, queries, units

DOCS = "doc_id long, text string, source string"


def _frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def test_line_dedup(spark):
    line, other = "The same old line of words", "Another line that has words"
    rows = [
        (1, f"{line}\n{other}\n\nok", "a"),
        (2, f"fresh words are in here\nthe SAME, old line of words!\nok", "a"),
        (3, f"{other}\n{other}", "b"),
        (4, None, None),
        (5, "", "b"),
        (None, line, "b"),
        (7, f"only here are these words\nonly here are these words", "b"),
        (7, f"only here are these words\nonly here are these words", "b"),
        (8, "word " * 60_000, "b"),
    ]
    found = {}
    clashing = _frame(spark, rows).withColumn("gone", F.lit(1)).withColumn("digest", F.lit("x"))
    for r in units.drop_repeated_units(clashing, min_words=4).collect():  # the option that leaves short lines alone
        found.setdefault(r["doc_id"], []).append(r)
    assert found[1][0]["text"] == rows[0][1] and found[1][0]["n_units"] == 4
    assert found[2][0]["text"] == "fresh words are in here\nok"
    start = len("fresh words are in here\n")
    assert found[2][0]["removed_starts"] == [start] and found[2][0]["removed_ends"] == [start + 28]
    assert found[3][0]["text"] == "" and found[3][0]["n_removed"] == 2
    assert found[4][0]["text"] is None and found[4][0]["n_units"] == 0
    assert found[5][0]["text"] == "" and found[5][0]["n_units"] == 1
    assert found[None][0]["text"] == ""
    assert [r["text"] for r in found[7]] == ["only here are these words"] * 2
    assert found[8][0]["n_removed"] == 0
    assert units.drop_repeated_units(_frame(spark, [])).count() == 0
    parts = units.drop_repeated_units(_frame(spark, [(1, f"{line}\n{other}\n\n{line}\n{other}", "a")]), unit="paragraph").first()
    assert parts["n_units"] == 2 and parts["text"] == f"{line}\n{other}"


def test_line_dedup_of_short_and_unspaced_lines(spark, tmp_path):
    chinese = "\u8fd9\u662f\u4e00\u884c\u91cd\u590d\u7684\u6587\u5b57"
    rows = [(1, f"Read more\n{chinese}\n---\n1\n", "a"), (2, f"read more!\nnew\n{chinese}\n---\n1\n", "a")]
    _frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: (r["text"], r["removed_spans"]) for r in queries.op1_line_dedup(spark, str(tmp_path)).collect()}
    assert found == {1: (rows[0][1], ""), 2: ("new\n---\n", "0-10,15-24,29-30")}
    assert {r["doc_id"]: r["text"] for r in units.drop_repeated_units(_frame(spark, rows)).collect()}[2] == "new\n---\n"
    kept = {r["doc_id"]: r["text"] for r in units.drop_repeated_units(_frame(spark, rows), min_words=4).collect()}
    assert kept[2] == "read more!\nnew\n---\n1\n"


def _poisson(rate, unit):
    count, term, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= unit:
        count += 1
        term *= rate / count
        total += term
    return count


def test_mixing_follows_the_distribution(spark):
    rows = [(i, f"t{i}", "big" if i % 4 else "small") for i in range(400)] + [(900, None, None), (None, "", "big"), (5, "t5", "big")]
    docs = _frame(spark, rows).withColumn("copy", F.lit("old")).withColumn("steps", F.lit(0.5)).withColumn("_key", F.lit(1))
    mixed = mixing.poisson_mix(docs, alpha=0.5, budget=3.0)
    assert set(mixed.columns) == {*docs.columns, "mix_key"}
    counts = {"big": 302, "small": 100, None: 1}
    total = sum(math.sqrt(n) for n in counts.values())
    units_ = {r[0]: r[1] for r in docs.select("doc_id", mixing.unit_hash(17, F.col("doc_id"))).collect()}
    expected = {}
    for key, _, source in rows:
        rate = math.sqrt(counts[source]) / total * 3.0 * 403 / counts[source]
        expected[key] = expected.get(key, 0) + _poisson(rate, units_[key])
    got = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {k: n for k, n in expected.items() if n}
    again = mixing.poisson_mix(docs, alpha=0.5, budget=3.0).select("mix_key").orderBy("mix_key").collect()
    assert again == mixed.select("mix_key").orderBy("mix_key").collect()


def test_mixing_with_given_weights(spark):
    rows = [(i, "x", s) for i, s in enumerate(["a"] * 500 + ["b"] * 500 + ["c"] * 10)]
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", -1.0), ("z", 5.0), ("b", None)], "source string, weight double")
    got = {r["source"]: r["n"] for r in mixing.poisson_mix(_frame(spark, rows), weights).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert "c" not in got and 650 < got["a"] < 860 and 190 < got["b"] < 320
    assert mixing.poisson_mix(_frame(spark, [])).count() == 0
    nothing = weights.where("source = 'z'")
    assert mixing.poisson_mix(_frame(spark, rows), nothing).count() == 0


def test_large_rates_do_not_underflow(spark):
    rates = spark.createDataFrame([("=a", 1000.0), ("=b", 0.0)], "_key string, rate double")
    steps = mixing.poisson_steps(rates).collect()
    assert len(steps) == 1 and abs(steps[0]["steps"][-1] - 1) < 1e-9
    assert 990 < sum(1 for s in steps[0]["steps"] if s <= 0.5) < 1010


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software, to deal in the Software without restriction.

The above copyright notice and this permission notice shall be included in all copies.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, express or implied."""


def test_license_scan(spark):
    rows = [
        (1, "Some prose.\nThis work is licensed under the GNU General Public License, version 3.", "a"),
        (2, "Copyright (c) 2020 Someone\n\n" + MIT, "a"),
        (3, None, None),
        (4, "", "a"),
        (5, "No such words here. At all!", "a"),
        (6, "Licensed under the Apache License, Version 2.0. You may obtain a copy of the License at http://x/LICENSE-2.0\n\n"
            "Released under the MIT License.", "a"),
        (7, "All rights reserved.", "a"),
        (8, "You may not use this file except in compliance with the License.", "a"),
        (None, "// SPDX-License-Identifier: BSD-3-Clause", "a"),
        (1, "Licensed under CC BY-NC 4.0.", "a"),
        (9, "word " * 60_000 + "\n\nReleased under the MIT License.", "a"),
    ]
    docs = _frame(spark, rows).withColumn("licenses", F.lit(1)).withColumn("_reduced", F.lit(2))
    found = sorted(((r["doc_id"] or 0, r["licenses"], r["verdict"], r["left_over"]) for r in licenses.license_scan(docs).collect()))
    assert found == [
        (0, "BSD-3-Clause", "known", ""),
        (1, "CC-BY-NC-4.0", "known", ""),
        (1, "GPL-3.0-only", "known", ""),
        (2, "MIT", "known", "<copyright-notice>"),
        (3, "", "none", ""),
        (4, "", "none", ""),
        (5, "", "none", ""),
        (6, "Apache-2.0,MIT", "known", ""),
        (7, "", "none", "<all-rights>"),
        (8, "", "unknown", "<apache-limits>"),
        (9, "MIT", "known", ""),
    ]
    assert licenses.license_scan(_frame(spark, [])).count() == 0


SENTENCE_OF = {
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache-2": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl-2-plus": "SPDX-License-Identifier: GPL-2.0-or-later",
    "spdx-gpl-2": "SPDX-License-Identifier: GPL-2.0-only",
    "spdx-gpl-3-plus": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-gpl-3": "SPDX-License-Identifier: GPL-3.0-only",
    "spdx-bsd-3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-bsd-2": "SPDX-License-Identifier: BSD-2-Clause",
    "spdx-mpl-2": "SPDX-License-Identifier: MPL-2.0",
    "spdx-isc": "SPDX-License-Identifier: ISC",
    "copyright-notice": "Copyright (c) 2020 Someone",
    "all-rights": "All rights reserved.",
    "apache-ref-2": "Licensed under the Apache License, Version 2.0.",
    "apache-limits": "You may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://x",
    "apache-basis": 'Software distributed under the License is distributed on an "AS IS" BASIS.',
    "mit-ref": "Released under the terms of the MIT license.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "mit-notice": "The above copyright notice and this permission notice shall be included",
    "mit-disclaimer": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose",
    "isc-disclaimer": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification",
    "bsd-source": "Redistributions of source code must retain the above copyright notice",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice",
    "bsd-endorse": "The names may be used to endorse or promote products",
    "bsd-disclaimer": "This software is provided by the holders as is and any express or implied warranties",
    "bsd-ref": "Available under the BSD license.",
    "gpl-3-plus": "GNU General Public License as published in version 3 or any later version",
    "gpl-3": "The GNU General Public License, version 3",
    "gpl-2-plus": "GNU General Public License as published in version 2 or any later version",
    "gpl-2": "The GNU General Public License, version 2",
    "lgpl-ref": "The GNU Lesser General Public License",
    "agpl-ref": "The GNU Affero General Public License",
    "gpl-warranty": "without even the implied warranty of MERCHANTABILITY or FITNESS",
    "mpl-ref-2": "Mozilla Public License, version 2.0",
    "cc-by-nc-sa-4": "This text is released under CC BY-NC-SA 4.0",
    "cc-by-nc-nd-4": "This text is available under CC BY-NC-ND 4.0",
    "cc-by-nc-4": "This text is released under Creative Commons BY-NC 4.0",
    "cc-by-sa-4": "available under Creative Commons BY-SA 4.0",
    "cc-by-nd-4": "released under a CC BY-ND 4.0",
    "cc-by-4": "This dataset is released under CC BY 4.0",
    "public-domain": "This work is dedicated to the public domain.",
    "cc-by-nc-sa-4-name": "Under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-4-name": "Under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc-by-nc-4-name": "Under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-sa-4-name": "Under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nd-4-name": "Under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-4-name": "Under a Creative Commons Attribution 4.0 International License.",
}


def test_every_known_sentence_is_found(spark):
    names = [i for i, _ in licenses.SENTENCES + licenses.NAMES]
    assert sorted(SENTENCE_OF) == sorted(names)
    rows = [(2 * n, SENTENCE_OF[i], i) for n, i in enumerate(names)]
    rows += [(2 * n + 1, SENTENCE_OF[i].replace(" ", "\n"), i) for n, i in enumerate(names)]  # a line end at every space
    found = {r["doc_id"]: r for r in licenses.license_scan(_frame(spark, rows)).collect()}
    for key, text, name in rows:
        assert f"<{name}>" in found[key]["sentence_ids"], text
        if name.startswith("cc-by"):
            assert (found[key]["licenses"], found[key]["verdict"]) == (name.upper().removesuffix("-4-NAME").removesuffix("-4") + "-4.0", "known")


def test_a_name_after_its_short_form_is_one_licence(spark):
    text = "Released under CC BY-SA 4.0. That is the Creative Commons Attribution-ShareAlike 4.0 International License."
    docs = _frame(spark, [(1, text, "a"), (2, "My own terms", "a")])
    assert licenses.license_scan(docs).where("doc_id = 1").first()["licenses"] == "CC-BY-SA-4.0"
    mine = licenses.license_scan(docs, known=[("mine", "my own terms")], rules=[("Mine", "<mine>")])
    assert mine.where("doc_id = 2").first()["licenses"] == "Mine"


def test_native_plans_have_no_python(spark):
    docs = _frame(spark, [(1, "a", "s")])
    for frame in (licenses.license_scan(docs), mixing.poisson_mix(docs)):
        plan = frame._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
