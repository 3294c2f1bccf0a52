"""Full texts of common licences, as copies in this folder, and the forms they come in.

A licence is known with each of its titles and with none; where it ends its
terms before an appendix on how to apply it, also without the appendix; with
its links as https and as http; and, of the short ones, with numbered and with
plain conditions.
"""

from __future__ import annotations

import re
from importlib.resources import files

# Name, file, titles.  The text in the file may begin with any of the titles.
_GNU = "GNU {} License\nVersion {}"
_APACHE = "Apache License\nVersion 2.0, January 2004"
FULL = [
    ("Apache-2.0", "Apache-2.0", [_APACHE + "\n" + scheme + "://www.apache.org/licenses/" for scheme in ("http", "https")] + [_APACHE]),
    ("Artistic-1.0-Perl", "Artistic-1.0", ['The "Artistic License"', "The Artistic License"]),
    ("BSD-2-Clause", "BSD-2-Clause", ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "BSD License"]),
    ("BSD-3-Clause", "BSD-3-Clause", ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "BSD License"]),
    ("BSD-3-Clause", "BSD-3-Clause-Regents", ["BSD 3-Clause License", "BSD License"]),
    ("CC0-1.0", "CC0-1.0", ["Creative Commons Legal Code\nCC0 1.0 Universal", "CC0 1.0 Universal"]),
    ("GFDL-1.2", "GFDL-1.2", [_GNU.format("Free Documentation", "1.2, November 2002")]),
    ("GFDL-1.3", "GFDL-1.3", [_GNU.format("Free Documentation", "1.3, 3 November 2008")]),
    ("GPL-1.0", "GPL-1.0", [_GNU.format("General Public", "1, February 1989")]),
    ("GPL-2.0", "GPL-2.0", [_GNU.format("General Public", "2, June 1991")]),
    ("GPL-3.0", "GPL-3.0", [_GNU.format("General Public", "3, 29 June 2007")]),
    ("LGPL-2.0", "LGPL-2.0", [_GNU.format("Library General Public", "2, June 1991")]),
    ("LGPL-2.1", "LGPL-2.1", [_GNU.format("Lesser General Public", "2.1, February 1999")]),
    ("LGPL-3.0", "LGPL-3.0", [_GNU.format("Lesser General Public", "3, 29 June 2007")]),
    ("MPL-1.1", "MPL-1.1", ["Mozilla Public License\nVersion 1.1"]),
    ("MPL-2.0", "MPL-2.0", ["Mozilla Public License Version 2.0", "Mozilla Public License, version 2.0"]),
    ("Unlicense", "Unlicense", ["The Unlicense", "Unlicense"]),
]
# Titles of the short texts that the module beside this folder holds.
SHORT_TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License", "0BSD"],
}
_END = re.compile(r"^[ \t]*END OF TERMS AND CONDITIONS[ \t]*$", re.M)
_ADDENDUM = re.compile(r"^[ \t]*ADDENDUM: How to use this License", re.M)


def without_title(text: str, titles: list[str]) -> str:
    for title in sorted(titles, key=len, reverse=True):
        words = map(re.escape, re.findall(r"[^\W_]+", title))
        if found := re.match(r"[\W_]*" + r"[\W_]+".join(words) + r"\b(?:(?!\n[\W_]*[(\[<©])[\W_])*", text, re.I):
            return text[found.end() :]
    return text


def _forms(text: str, titles: list[str]) -> set[str]:
    body = without_title(text, titles)
    bodies = {body}
    if end := _END.search(body):
        bodies |= {body[: end.start()], body[: end.end()]}
    if end := _ADDENDUM.search(body):
        bodies.add(body[: end.start()])
    if body.lstrip().startswith("CREATIVE COMMONS CORPORATION"):
        bodies.add(body[body.index("Statement of Purpose") :])
    if re.search(r"^1\. Redistributions", body, re.M):
        bodies.add(re.sub(r"^\d\. ", "* ", body, flags=re.M))
    bodies |= {b.replace("https://", "http://") for b in bodies}
    return {f"{title}\n\n{b}" for title in titles for b in bodies} | bodies


def known_texts(short: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(name, text): the ``short`` texts, and all forms of these and the full ones."""
    out = dict.fromkeys(short)
    for name, text in short:
        if "\n\n" in text:
            out |= dict.fromkeys((name, form) for form in sorted(_forms(text, SHORT_TITLES[name])))
    for name, file, titles in FULL:
        text = files(__name__).joinpath(f"{file}.txt").read_text("utf-8")
        out |= dict.fromkeys((name, form) for form in sorted(_forms(text, titles)))
    return list(out)
