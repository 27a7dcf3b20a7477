import textwrap

import duckdb
from helpers import ODD_TEXTS, docs, prose

from tallow.llm import licences as X

MIT = next(t for i, t in X.KNOWN if len(t) > 500 and i == "MIT")


def corpus(spark):
    rows = [(1, "Copyright (c) 2024 Someone\n\n" + MIT.upper().replace("LICENSE", "LICENCE")), (2, "released under the mit licence"),
            (3, prose(1, 30) + "\n  Licensed under CC BY-NC 4.0!\nReleased under the MIT License.\nReleased under the MIT License.\n" + prose(2, 9)),
            (4, "This work is licensed under the GNU General Public License, v 3."), (5, MIT + " and more"), (6, "© 2020 A\nAll rights reserved.")]
    return docs(spark, [*rows, (2, "released under the mit licence"), (None, "SPDX-License-Identifier: MIT"), *[(10 + i, t) for i, t in enumerate(ODD_TEXTS)]])


def test_lookup_of_whole_texts_and_lines(spark):
    got = {r["doc_id"]: r for r in X.scan(corpus(spark)).collect()}
    assert [got[i]["text_licence"] for i in (1, 2, 3, 4, 5, 6)] == ["MIT", "MIT", None, "GPL-3.0-only", None, None]
    assert (got[3]["notice_lines"], got[3]["notice_licences"]) == (3, "CC-BY-NC-4.0,MIT")
    assert got[5]["notice_lines"] == 0 and got[None]["text_licence"] == "MIT" and got[2]["notice_lines"] == 1
    assert all(got[10 + i]["text_licence"] is None for i in range(len(ODD_TEXTS)))


def test_equals_sql_with_repeated_rows_and_clashing_names(spark):
    d = corpus(spark).withColumnRenamed("lang", "digest").withColumnRenamed("source", "licence")
    documents = d.toPandas()  # noqa: F841 - read by DuckDB
    want = duckdb.sql(X.ORACLE_SQL)
    cols = sorted(want.columns)
    fix = lambda rows: sorted(str(tuple(None if v != v else v for v in r)) for r in rows)
    got = [tuple(r) for r in X.scan(d).select(*cols).collect()]
    assert fix(want.project("CAST(doc_id AS BIGINT) AS doc_id, * EXCLUDE doc_id").project(", ".join(cols)).fetchall()) == fix(got)


def test_empty_table(spark):
    assert X.scan(corpus(spark).limit(0)).count() == 0


def test_standard_files_with_their_titles(spark):
    def wrapped(text):
        return "\n".join(textwrap.wrap(text, 78))

    bsd = next(t for i, t in X.KNOWN if i == "BSD-3-Clause" and t.startswith("Redistribution"))
    files = docs(spark, [(1, "MIT License\n\nCopyright (c) 2024 Someone\n\n" + wrapped(MIT) + "\n"), (2, "The MIT License (MIT)\n\n" + MIT),
                         (3, "BSD 3-Clause License\n\nCopyright (c) 2024, Someone\nAll rights reserved.\n\n" + bsd),
                         (4, "SPDX-License-Identifier: MPL-2.0"), (5, "MIT License")])
    got = {r["doc_id"]: r["text_licence"] for r in X.scan(files).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "BSD-3-Clause", 4: "MPL-2.0", 5: None}
