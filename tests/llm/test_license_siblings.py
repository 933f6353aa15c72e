"""Sibling licenses are not confused with each other."""

import pytest

from skewkit.llm import licenses

scan = licenses.Scanner().scan


@pytest.mark.parametrize("text, names", [
    ("Released under the BSD License.", ["BSD"]), ("Released under the Frobnic License.", []), ("Released under the Two Word License.", []),
    ("Released under the MIT-0 License.", ["MIT-0"]), ("Released under the Modified MIT License.", []), ("Released under the MIT-style License.", []),
    ("Licensed under the MIT license", ["MIT"]), ("Distributed under the terms of the MIT License.", ["MIT"]),
    ("Released under the Apache License 2.0.", ["Apache-2.0"]), ("Licensed under the Apache License, Version 1.1.", []),
    ("Licensed under CC BY 3.0", ["CC-BY-3.0"]), ("Licensed under CC BY-ND 4.0", ["CC-BY-ND-4.0"]), ("Licensed under CC BY 4.0", ["CC-BY-4.0"]),
    ("Licensed under CC BY-NC-SA 4.0", ["CC-BY-NC-SA-4.0"]), ("Licensed under CC BY-NC-ND 3.0", ["CC-BY-NC-ND-3.0"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", ["CC-BY-NC-4.0-text"]),
    ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.0.", ["GPL-3.0"]),
    ("This work is licensed under the GNU General Public License, version 3.7.", []),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
    ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
    ("Released under the GNU GPL v3. Released under the BSD 3-Clause License.", ["GPL-3.0", "BSD-3-Clause"])])
def test_short_notices(text, names):
    assert [f[0] for f in scan(text)] == names


def test_every_template_is_found_as_itself():
    for name, text in licenses.TEMPLATES.items():
        assert [f[:2] for f in scan("foo bar. " + text + " baz")] == [(name.split("#")[0], 1.0)], name


@pytest.mark.parametrize("name, old, new, found", [
    ("GPL-3.0-header", "version 3", "version 2", "GPL-2.0-header"), ("GPL-3.0-header", "GNU General", "GNU Lesser General", "LGPL-3.0-header"),
    ("GPL-2.0-header", "version 2", "version 4", None), ("LGPL-2.1-header", "2.1", "2.7", None),
    ("Apache-2.0-header", "Version 2.0", "Version 1.9", None), ("BSD-4-Clause-text", "advertising materials", "materials", "BSD-3-Clause-text"),
    ("X11-text", "Except as contained in this notice, ", "", "MIT-text"), ("CC-BY-text", "4.0", "9.0", None)])
def test_changed_headers_and_texts(name, old, new, found):
    text = licenses.TEMPLATES[name].replace(old, new)
    assert [f[0] for f in scan(text)] == ([found] if found else [])


def test_a_license_that_goes_on_is_the_longer_one():
    text = licenses.TEMPLATES["BSD-3-Clause-text"].replace("the copyright holder nor", "Jane Roe and Co nor")
    assert [f[0] for f in scan(text)] == ["BSD-3-Clause-text"]
    assert [f[0] for f in scan(text[:text.index(" 3. Neither")])] == ["BSD-2-Clause-text"]
