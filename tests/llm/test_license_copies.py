"""Copies of known licence texts as they stand in real files."""

import re
import textwrap

from runway.llm.license_scan import TEXT_MARKS, scan_licenses
from runway.llm.license_texts import TEXTS, whole_texts


def found(spark, texts):
    rows = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r["license"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_every_known_text_in_every_shape(spark):
    known = whole_texts()
    assert all(re.search(TEXT_MARKS, t.lower()) for _, t in known)
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense", "BSL-1.0", "CC0-1.0"} <= {k for k, _ in known}
    rewrapped = ["\n\n".join(textwrap.fill(p, 50) for p in re.split(r"\n\s*\n", t)) for _, t in known]
    commented = ["\n".join(" * " + line for line in t.split("\n")) for _, t in known]
    for shape in ([t for _, t in known], rewrapped, commented, [t.upper() for _, t in known]):
        assert [(k, t[:60]) for (k, t), g in zip(known, found(spark, shape)) if g != k] == []
    one_line = [(k, " ".join(t.split())) for k, t in known]
    got = found(spark, [t for _, t in one_line])
    assert [(k, t[:60]) for (k, t), g in zip(one_line, got) if g != k] == []


def test_untitled_bulleted_and_one_line_copies(spark):
    text = dict(TEXTS)
    mit = text["MIT"].removeprefix("MIT License").strip()
    bsd = text["BSD-3-Clause"].removeprefix("BSD 3-Clause License").strip()
    head = "Copyright (c) 2010-2012, A. B. Smith Inc.\nAll rights reserved.\n\n"
    copies = [
        ("MIT", mit), ("MIT", "Copyright 2020 Foo Bar\n\n" + mit), ("MIT", "Copyright Foo Bar\n\n" + mit),
        ("MIT", " ".join(("The MIT License (MIT) Copyright (c) 2020 Foo Bar Ltd. " + mit).split())),
        ("BSD-3-Clause", head + bsd), ("BSD-3-Clause", head + re.sub(r"(?m)^\d\.", "  *", bsd)),
        ("BSD-3-Clause", " ".join((head + re.sub(r"(?m)^(\d)\.", r"(\1)", bsd)).split())),
        ("BSD-3-Clause", head + bsd.replace("the copyright holder nor the\nnames of its", "Foo, Inc. nor the names of its")),
        (None, "Copyright notices cost ten dollars each\n" + mit),
        (None, "Copyright (c) 2020 Foo. You must pay us first.\n" + mit),
        (None, mit + "\nMore terms."), (None, bsd.replace("1. Redistributions", "Redistributions of binaries")),
        (None, "Copyright 2020 Foo all other text of this line")]
    assert found(spark, [t for _, t in copies]) == [k for k, _ in copies]


def test_spdx_lines(spark):
    rows = [(1, "// SPDX-License-Identifier: GPL-2.0-only\nint x;\n# SPDX-License-Identifier: AGPL-3.0-or-later")]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()[0]
    assert (got["n_notices"], got["notices"], got["license"]) == (2, "AGPL-3.0-or-later,GPL-2.0", None)
