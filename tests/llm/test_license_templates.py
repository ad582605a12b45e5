"""The registered license table: common wordings, full texts and notices under five words."""

import pytest

from strata.llm import license_templates, licenses
from strata.llm.common import alnum_words

from .helpers import docs

HEADER = ("This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as "
          "published by the Free Software Foundation, either version {v} of the License, or (at your option) any "
          "later version.\n\nThis {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY")
WORDINGS = [
    ("GPL-3.0", HEADER.format(what="program", name="GNU General Public License", v="3")),
    ("GPL-2.0", HEADER.format(what="file", name="GNU General Public License", v="2")),
    ("LGPL-2.1", HEADER.format(what="library", name="GNU Lesser General Public License", v="2.1")),
    ("AGPL-3.0", HEADER.format(what="program", name="GNU Affero General Public License", v="3")),
    ("MIT", "// SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "# SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "/* SPDX-License-Identifier: GPL-2.0-or-later */"),
    ("All-rights-reserved", "All rights reserved."),
    ("All-rights-reserved", "some text before. Copyright 2020 A. Body. All Rights Reserved, and after"),
    ("CC-BY-SA-3.0", "Licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("CC-BY-NC-ND-4.0", "see https://creativecommons.org/licenses/by-nc-nd/4.0/"),
    ("LGPL-3.0", "released under the LGPLv3 by its authors"),
]


def _rows(found):
    rows = {}
    for r in found.collect():
        rows.setdefault(r.doc_id, {})[r.license] = r
    return rows


def test_common_wordings_get_their_license_only(spark):
    got = _rows(licenses.scan_licenses(docs(spark, [(k, t) for k, (_, t) in enumerate(WORDINGS)])))
    for k, (name, _) in enumerate(WORDINGS):
        assert list(got.get(k, ())) == [name], (k, got.get(k))
        assert got[k][name].containment == 1.0


def test_full_texts_are_found_in_longer_documents(spark):
    texts = license_templates.full_texts()
    assert {"ISC", "Zlib", "Unlicense", "GPL-3.0", "LGPL-2.1"} <= {n for n, _ in texts}
    rows = [(k, f"{'other words stand here ' * 40} {t} {'and more of them ' * 40}") for k, (_, t) in enumerate(texts)]
    got = _rows(licenses.scan_licenses(docs(spark, rows)))
    for k, (name, text) in enumerate(texts):
        row = got[k][name]
        assert row.containment == 1.0
    # a text with a tenth of its words cut is still the license
    cut = [(k, " ".join(w for i, w in enumerate(t.split()) if i % 400 >= 40)) for k, (_, t) in enumerate(texts)]
    got = _rows(licenses.scan_licenses(docs(spark, cut)))
    long = [k for k, (_, t) in enumerate(texts) if len(t.split()) > 1000]
    assert long and all(texts[k][0] in got[k] for k in long)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_short_templates_equal_brute_force(spark, n):
    words = ["aa", "bb", "cc", "dd"]
    made = [("L", " ".join(words[:n])), ("M", " ".join(words[:n][::-1])), ("none", "...")]
    rows = [(0, "Aa bb CC dd"), (1, "dd cc bb aa"), (2, "xx aa bb. cc, dd yy"), (3, "bb"), (4, ""), (5, None),
            (6, "zz aa"), (7, "bb cc dd")]  # the last two hold a sequence only together
    table = spark.createDataFrame(made, "license string, text string")
    got = {(r.doc_id, r.license, r.first_word, r.n_words) for r in licenses.scan_licenses(docs(spark, rows), table).collect()}
    want = set()
    for i, t in rows:
        w = alnum_words(t)
        for name, text in made[:2]:
            own = alnum_words(text)
            at = [k for k in range(len(w) - n + 1) if w[k:k + n] == own]
            want |= {(i, name, at[0], n)} if at else set()
    assert got == want
