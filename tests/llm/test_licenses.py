"""Licences: usual wordings, and every start and template tried."""

import pytest

from wattle.llm import licenses

GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} License as "
       "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
       "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
       "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. {}"
       "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES")
NEITHER = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
           "products derived from this software without specific prior written permission. ")


@pytest.fixture(scope="module")
def names():
    s = licenses.Scanner()
    return lambda t: {x["license"] for x in s.scan(t)}


@pytest.mark.parametrize("text, name", [
    (GPL.format("General Public", "3"), "GPL-3.0"), (GPL.format("General Public", "2"), "GPL-2.0"),
    (GPL.format("Lesser General Public", "2.1"), "LGPL-2.1"), (GPL.format("Lesser General Public", "3"), "LGPL-3.0"),
    (GPL.format("Affero General Public", "3"), "AGPL-3.0"),
    ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3", "GPL-3.0"),
    ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "GPL-3.0"), ("GNU GENERAL PUBLIC LICENSE Version 3", "GPL-3.0"),
    ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0"), ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"), ("SPDX-License-Identifier: ISC", "ISC"),
    ("the code is under GPLv3 since May", "GPL-3.0"), ("Apache License Version 2.0, January 2004", "Apache-2.0"),
    (BSD.format(""), "BSD-2-Clause"), (BSD.format(NEITHER), "BSD-3-Clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies.", "ISC"),
    ("Eclipse Public License - v 2.0", "EPL-2.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense")])
def test_usual_wordings(names, text, name):
    assert names(text) == {name}
    assert name in names("alpha beta " * 40 + text + " gamma delta" * 40)


def test_spdx_expressions(names):
    assert names("SPDX-License-Identifier: (MIT OR Apache-2.0)") == {"MIT", "Apache-2.0"}
    assert names("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR MIT") == {"GPL-2.0", "MIT"}


def test_a_changed_first_word_is_found_beside_the_unchanged_one():
    s = licenses.Scanner((("X-1", ("Licensed under the Exact Sample Terms Version 2.0",), ("exact", "sample", "2.0")),))
    text = "License under the Exact Sample Terms, Version 2.0"
    assert [x["license"] for x in s.scan(text)] == ["X-1"]
    assert [x["license"] for x in s.scan(text + " and parts are licensed otherwise")] == ["X-1"]


def test_every_template_that_saves_enough_is_confirmed():
    kinds = ("alphabetical", "botanical", "chemical", "dramatical", "ethical", "fantastical")
    s = licenses.Scanner(tuple((f"X-{k}", (f"{k} sampleterms",), (k,)) for k in kinds))
    text = "licensed under " + ", ".join(f"{k} sampleterms" for k in kinds)
    assert {x["license"] for x in s.scan(text)} == {f"X-{k}" for k in kinds}


def test_a_line_of_many_licenses_gives_them_all(names):
    text = ("Licensed under CC BY 4.0, CC BY-SA 4.0, CC BY-NC 4.0, the MIT License, the Apache License, Version 2.0, "
            "GNU General Public License version 2 and GNU General Public License version 3")
    assert names(text) == {"CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0"}
