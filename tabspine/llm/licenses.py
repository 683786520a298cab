"""Licence scans with ordered signature rules, in Spark expressions only.

Every rule is a regular expression: wording of a licence or of its notices, a URL, a trove classifier, or a licence's name and a form of
words before it, such as a grant, a metadata field, a reference, nothing at all, or an SPDX tag before an identifier. The form
gives the priority. A name or signature is tried only on texts that have its keywords, and forms only where a name was found.
Matches are intervals of the text. One that lies within an interval of at least its priority is suppressed, so "GNU General
Public License" inside a grant under version 3 gives one detection. All work on a text happens in its own row: nothing is
shuffled. Running sums and maxima over a text's matches go by chunks, so a text with very many matches takes time nearly in
proportion.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Between two words of a name.
_GAP = r"[\s,.;:()\"'_/-]{1,6}"
#: Between two words of a signature, comment marks included.
_LOOSE = r"[\W_]{1,12}"
_VERSION = rf"(?:{_GAP}(?:version|v\.?))?[\s,v-]{{0,3}}"

#: Label, SPDX identifiers, names as regular expressions. "~" stands for a gap between words and
#: "@" for what may stand before a version number.
LICENSES: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("mit", ("MIT", "MIT-0", "X11"), ("mit~licen[cs]e", "mit~style~licen[cs]e", "expat~licen[cs]e", "mit")),
    ("apache-2", ("Apache-2.0",), ("apache(?:~software)?~licen[cs]e@2(?:\\.0)?", "apache@2(?:\\.0)?")),
    ("apache-1.1", ("Apache-1.1",), ("apache(?:~software)?~licen[cs]e@1\\.1", "apache@1\\.1")),
    ("apache-1", ("Apache-1.0",), ("apache(?:~software)?~licen[cs]e@1\\.0",)),
    ("bsd-2", ("BSD-2-Clause",), ("(?:2|two)~clause~bsd(?:~licen[cs]e)?", "bsd~(?:2|two)~clause", "(?:simplified|freebsd)~bsd(?:~licen[cs]e)?")),
    ("bsd-3", ("BSD-3-Clause",), ("(?:3|three)~clause~bsd(?:~licen[cs]e)?", "bsd~(?:3|three)~clause", "(?:new|revised|modified)~bsd(?:~licen[cs]e)?")),
    ("bsd-4", ("BSD-4-Clause",), ("(?:4|four)~clause~bsd(?:~licen[cs]e)?", "(?:original|old)~bsd~licen[cs]e")),
    ("bsd-0", ("0BSD",), ("zero~clause~bsd(?:~licen[cs]e)?",)),
    ("bsd", (), ("bsd~(?:style~)?licen[cs]e",)),
    ("isc", ("ISC",), ("isc~licen[cs]e",)),
    ("zlib", ("Zlib",), ("zlib(?:~libpng)?~licen[cs]e",)),
    ("boost-1", ("BSL-1.0",), ("boost~software~licen[cs]e(?:@1\\.0)?",)),
    ("gpl-1", ("GPL-1.0-only", "GPL-1.0-or-later"), ("(?:gnu~)?general~public~licen[cs]e@1(?:\\.0)?", "(?:gnu~)?gpl@1(?:\\.0)?",)),
    ("gpl-2", ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"), ("(?:gnu~)?general~public~licen[cs]e@2(?:\\.0)?", "(?:gnu~)?gpl@2(?:\\.0)?",)),
    ("gpl-3", ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"), ("(?:gnu~)?general~public~licen[cs]e@3(?:\\.0)?", "(?:gnu~)?gpl@3(?:\\.0)?",)),
    ("gpl", (), ("gnu~general~public~licen[cs]e", "gnu~gpl")),
    ("lgpl-2", ("LGPL-2.0-only", "LGPL-2.0-or-later"), ("(?:gnu~)?library~general~public~licen[cs]e@2(?:\\.0)?", "(?:gnu~)?lgpl@2(?:\\.0)?",)),
    ("lgpl-2.1", ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"), ("(?:gnu~)?lesser~general~public~licen[cs]e@2\\.1", "(?:gnu~)?lgpl@2\\.1",)),
    ("lgpl-3", ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"), ("(?:gnu~)?lesser~general~public~licen[cs]e@3(?:\\.0)?", "(?:gnu~)?lgpl@3(?:\\.0)?",)),
    ("lgpl", (), ("gnu~(?:lesser|library)~general~public~licen[cs]e", "gnu~lgpl")),
    ("agpl-3", ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), ("(?:gnu~)?affero~general~public~licen[cs]e@3(?:\\.0)?", "(?:gnu~)?agpl@3(?:\\.0)?",)),
    ("agpl", (), ("gnu~affero~general~public~licen[cs]e", "gnu~agpl")),
    ("fdl", ("GFDL-1.2-only", "GFDL-1.3-only"), ("gnu~free~documentation~licen[cs]e(?:@1\\.[123])?",)),
    ("mpl-1.1", ("MPL-1.1",), ("mozilla~public~licen[cs]e@1\\.1", "mpl@1\\.1")),
    ("mpl-2", ("MPL-2.0",), ("mozilla~public~licen[cs]e@2(?:\\.0)?", "mpl@2(?:\\.0)?")),
    ("epl-1", ("EPL-1.0",), ("eclipse~public~licen[cs]e@1(?:\\.0)?",)),
    ("epl-2", ("EPL-2.0",), ("eclipse~public~licen[cs]e@2(?:\\.0)?",)),
    ("cddl-1", ("CDDL-1.0", "CDDL-1.1"), ("common~development~and~distribution~licen[cs]e(?:@1\\.[01])?", "cddl(?:@1\\.[01])?")),
    ("cpl-1", ("CPL-1.0",), ("common~public~licen[cs]e(?:@1\\.0)?",)),
    ("eupl", ("EUPL-1.1", "EUPL-1.2"), ("european~union~public~licen[cs]e(?:@1\\.[12])?", "eupl(?:@1\\.[12])?")),
    ("artistic-1", ("Artistic-1.0", "Artistic-1.0-Perl"), ("artistic~licen[cs]e@1(?:\\.0)?",)),
    ("artistic-2", ("Artistic-2.0",), ("artistic~licen[cs]e@2(?:\\.0)?",)),
    ("psf-2", ("PSF-2.0", "Python-2.0"), ("python~software~foundation~licen[cs]e(?:@2(?:\\.0)?)?",)),
    ("php-3", ("PHP-3.0", "PHP-3.01"), ("php~licen[cs]e@3(?:\\.01?)?",)),
    ("postgresql", ("PostgreSQL",), ("postgresql~licen[cs]e",)),
    ("openssl", ("OpenSSL",), ("openssl~licen[cs]e",)),
    ("ncsa", ("NCSA",), ("university~of~illinois~(?:ncsa~)?open~source~licen[cs]e",)),
    ("ofl-1.1", ("OFL-1.1",), ("sil~open~font~licen[cs]e(?:@1\\.1)?",)),
    ("unlicense", ("Unlicense",), ("the~unlicen[cs]e",)),
    ("wtfpl", ("WTFPL",), ("wtfpl",)),
    ("ms-pl", ("MS-PL",), ("microsoft~public~licen[cs]e",)),
    ("ms-rl", ("MS-RL",), ("microsoft~reciprocal~licen[cs]e",)),
    ("odbl-1", ("ODbL-1.0",), ("open~(?:data~commons~open~)?database~licen[cs]e(?:@1\\.0)?",)),
    ("cc0-1", ("CC0-1.0",), ("cc0(?:~1\\.0)?(?:~universal)?", "creative~commons~(?:cc0|zero)(?:~1\\.0)?")),
    ("cc-by-nc-sa", ("CC-BY-NC-SA-3.0", "CC-BY-NC-SA-4.0"), ("cc~by~nc~sa(?:@[1-4]\\.0)?", "creative~commons~by~nc~sa(?:@[1-4]\\.0)?", "creative~commons~attribution~noncommercial~share~?alike(?:@[1-4]\\.0)?")),
    ("cc-by-nc-nd", ("CC-BY-NC-ND-3.0", "CC-BY-NC-ND-4.0"), ("cc~by~nc~nd(?:@[1-4]\\.0)?", "creative~commons~by~nc~nd(?:@[1-4]\\.0)?", "creative~commons~attribution~noncommercial~no~?deriv(?:ative)?s?(?:@[1-4]\\.0)?")),
    ("cc-by-nc", ("CC-BY-NC-3.0", "CC-BY-NC-4.0"), ("cc~by~nc(?:@[1-4]\\.0)?", "creative~commons~by~nc(?:@[1-4]\\.0)?", "creative~commons~attribution~non~?commercial(?:@[1-4]\\.0)?")),
    ("cc-by-sa", ("CC-BY-SA-3.0", "CC-BY-SA-4.0"), ("cc~by~sa(?:@[1-4]\\.0)?", "creative~commons~by~sa(?:@[1-4]\\.0)?", "creative~commons~attribution~share~?alike(?:@[1-4]\\.0)?")),
    ("cc-by-nd", ("CC-BY-ND-3.0", "CC-BY-ND-4.0"), ("cc~by~nd(?:@[1-4]\\.0)?", "creative~commons~by~nd(?:@[1-4]\\.0)?", "creative~commons~attribution~no~?deriv(?:ative)?s?(?:@[1-4]\\.0)?")),
    ("cc-by", ("CC-BY-3.0", "CC-BY-4.0"), ("cc~by(?:@[1-4]\\.0)", "creative~commons~by(?:@[1-4]\\.0)", "creative~commons~attribution(?:@[1-4]\\.0)?")),
    ("public-domain", (), ("public~domain",)),
    ("all-rights-reserved", (), ("all~rights~reserved",)),
)

#: Label, form and pattern of what tells a licence without its name, or with it inside. A blank stands for any few marks and spaces.
SIGNATURES: tuple[tuple[str, str, str], ...] = (
    ("mit", "wording", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "wording", "the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
    ("bsd", "wording", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3", "wording", "neither the name of [\\s\\S]{1,80}? nor the names of (?:its|any|other) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4", "wording", "all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment"),
    ("isc", "wording", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("apache-2", "wording", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "wording", "apache license version 2\\.0 january 2004"),
    ("apache-1.1", "wording", "this product includes software developed by the apache software foundation"),
    ("gpl-1", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu general public license as published by the free software foundation either version 1"),
    ("gpl-2", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu general public license as published by the free software foundation either version 2"),
    ("gpl-3", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu general public license as published by the free software foundation either version 3"),
    ("gpl-2", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu general public license version 2 as published by the free software foundation"),
    ("gpl-3", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu general public license version 3 as published by the free software foundation"),
    ("gpl-2", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu general public license version 2 june 1991"),
    ("gpl-3", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu general public license version 3 29 june 2007"),
    ("lgpl-2", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu library general public license as published by the free software foundation either version 2"),
    ("lgpl-2.1", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu lesser general public license as published by the free software foundation either version 2\\.1"),
    ("lgpl-3", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu lesser general public license as published by the free software foundation either version 3"),
    ("lgpl-2.1", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu lesser general public license version 2\\.1 february 1999"),
    ("lgpl-3", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu lesser general public license version 3 29 june 2007"),
    ("agpl-3", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu affero general public license as published by the free software foundation either version 3"),
    ("agpl-3", "wording", "(?:licensed |released |distributed )?(?:under the terms of the )?gnu affero general public license version 3 19 november 2007"),
    ("fdl", "wording", "permission is granted to copy distribute and(?: or)? modify this document under the terms of the gnu free documentation license"),
    ("mpl-2", "wording", "this source code form is subject to the terms of the mozilla public license v 2\\.0"),
    ("mpl-2", "wording", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", "wording", "the contents of this file are subject to the mozilla public license version 1\\.1"),
    ("epl-1", "wording", "made available under the terms of the eclipse public license v 1\\.0"),
    ("epl-2", "wording", "made available under the terms of the eclipse public license(?: v)? 2\\.0"),
    ("cddl-1", "wording", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl-1", "wording", "the accompanying program is provided under the terms of this common public license"),
    ("zlib", "wording", "in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose"),
    ("boost-1", "wording", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "wording", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "wording", "do what the fuck you want to public license"),
    ("artistic-1", "wording", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2", "wording", "this license establishes the terms under which a given free software package may be copied modified distributed"),
    ("psf-2", "wording", "this license agreement is between the python software foundation"),
    ("postgresql", "wording", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("openssl", "wording", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ncsa", "wording", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers"),
    ("ofl-1.1", "wording", "this font software is licensed under the sil open font license version 1\\.1"),
    ("ms-pl", "wording", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("cc0-1", "wording", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("public-domain", "wording", "this (?:work|file|code|software) is (?:hereby )?(?:released|dedicated|placed) (?:into|to|in) the public domain"),
    ("mit", "url", "opensource\\.org/license(?:s)?/mit"), ("mit", "url", "choosealicense\\.com/licenses/mit"),
    ("bsd-2", "url", "opensource\\.org/license(?:s)?/bsd-2-clause"), ("bsd-3", "url", "opensource\\.org/license(?:s)?/bsd-3-clause"),
    ("isc", "url", "opensource\\.org/license(?:s)?/isc"), ("apache-2", "url", "opensource\\.org/license(?:s)?/apache-2\\.0"),
    ("apache-2", "url", "apache\\.org/licenses/license-2\\.0"), ("apache-1.1", "url", "apache\\.org/licenses/license-1\\.1"),
    ("gpl-2", "url", "gnu\\.org/(?:old-)?licenses/(?:old-licenses/)?gpl-2\\.0"), ("gpl-3", "url", "gnu\\.org/licenses/gpl-3\\.0"),
    ("lgpl-2.1", "url", "gnu\\.org/(?:old-)?licenses/(?:old-licenses/)?lgpl-2\\.1"), ("lgpl-3", "url", "gnu\\.org/licenses/lgpl-3\\.0"),
    ("agpl-3", "url", "gnu\\.org/licenses/agpl-3\\.0"), ("fdl", "url", "gnu\\.org/licenses/fdl"),
    ("gpl-3", "url", "opensource\\.org/license(?:s)?/gpl-3\\.0"), ("gpl-2", "url", "opensource\\.org/license(?:s)?/gpl-2\\.0"),
    ("mpl-2", "url", "mozilla\\.org/(?:en-us/)?mpl/2\\.0"), ("mpl-1.1", "url", "mozilla\\.org/(?:en-us/)?mpl/1\\.1"),
    ("epl-1", "url", "eclipse\\.org/legal/epl-v10"), ("epl-2", "url", "eclipse\\.org/legal/epl-2\\.0"),
    ("boost-1", "url", "boost\\.org/license_1_0"), ("unlicense", "url", "unlicense\\.org"), ("wtfpl", "url", "wtfpl\\.net"),
    ("ofl-1.1", "url", "scripts\\.sil\\.org/ofl"), ("odbl-1", "url", "opendatacommons\\.org/licenses/odbl"),
    ("cc0-1", "url", "creativecommons\\.org/publicdomain/zero"), ("cc-by", "url", "creativecommons\\.org/licenses/by(?!-)"),
    ("cc-by-sa", "url", "creativecommons\\.org/licenses/by-sa"), ("cc-by-nd", "url", "creativecommons\\.org/licenses/by-nd"),
    ("cc-by-nc", "url", "creativecommons\\.org/licenses/by-nc(?!-)"), ("cc-by-nc-sa", "url", "creativecommons\\.org/licenses/by-nc-sa"),
    ("cc-by-nc-nd", "url", "creativecommons\\.org/licenses/by-nc-nd"),
    ("mit", "classifier", "license :: osi approved :: mit license"), ("apache-2", "classifier", "license :: osi approved :: apache software license"),
    ("bsd", "classifier", "license :: osi approved :: bsd license"), ("isc", "classifier", "license :: osi approved :: isc license"),
    ("gpl-2", "classifier", "license :: osi approved :: gnu general public license v2"), ("gpl-3", "classifier", "license :: osi approved :: gnu general public license v3"),
    ("lgpl-2", "classifier", "license :: osi approved :: gnu lesser general public license v2"),
    ("lgpl-3", "classifier", "license :: osi approved :: gnu lesser general public license v3"),
    ("agpl-3", "classifier", "license :: osi approved :: gnu affero general public license v3"),
    ("mpl-2", "classifier", "license :: osi approved :: mozilla public license 2\\.0"), ("mpl-1.1", "classifier", "license :: osi approved :: mozilla public license 1\\.1"),
    ("psf-2", "classifier", "license :: osi approved :: python software foundation license"), ("zlib", "classifier", "license :: osi approved :: zlib libpng license"),
    ("unlicense", "classifier", "license :: osi approved :: the unlicense"), ("boost-1", "classifier", "license :: osi approved :: boost software license 1\\.0"),
    ("epl-1", "classifier", "license :: osi approved :: eclipse public license 1\\.0"), ("epl-2", "classifier", "license :: osi approved :: eclipse public license 2\\.0"),
    ("eupl", "classifier", "license :: osi approved :: european union public licen[cs]e 1\\.[12]"), ("cc0-1", "classifier", "license :: cc0 1\\.0 universal"),
    ("public-domain", "classifier", "license :: public domain"),
)

#: What stands before a name in each form. The first three go before names, the last before SPDX identifiers.
_GRANT = rf"(?:licen[cs]ed|released|distributed|available|provided|published|covered|governed|redistributed|dedicated)(?:{_GAP}(?:under|by|to|with|in))(?:{_GAP}(?:the|a|an|terms|conditions|and|of)){{0,6}}{_GAP}"
#: Form, priority, pattern before the name.
FORMS: tuple[tuple[str, int, str], ...] = (
    ("wording", 95, ""),
    ("classifier", 92, ""),
    ("url", 85, ""),
    ("spdx tag", 100, r"spdx-licen[cs]e-identifier\s{0,4}:\s{0,4}[(]?"),
    ("field", 90, r"licen[cs]e\s{0,4}[:=]{1,2}\s{0,4}[\"'(\[]?"),
    ("grant", 80, _GRANT),
    ("reference", 60, rf"(?:under|see|per){_GAP}(?:(?:the|a|terms|of){_GAP}){{0,4}}"),
    ("name", 40, ""),
)
#: Characters before a name in which the longest form fits.
_CONTEXT = 160
#: Matches of a text whose running sums are taken together.
_CHUNK = 512

_MARKS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
#: A word, in text whose case is left as it is.
WORD = rf"[^{_MARKS}]+"

#: Label and words of the base phrases.
PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))


@dataclass(frozen=True)
class Name:
    """A name or identifier in order: ``gate`` finds all its places and perhaps more in lower case, ``pattern`` exactly its places."""

    label: str
    needs: tuple[str, ...]
    gate: str
    pattern: str
    forms: tuple[str, ...]


def _needs(name: str) -> tuple[str, ...]:
    """Letters that every text of a name has: the runs of a pattern outside its groups, which may be absent or differ."""
    while (plain := re.sub(r"\(\?:[^()]*\)\??", " ", name)) != name:
        name = plain
    return tuple(sorted(set(re.findall("[a-z]{2,}", re.sub(r"\[[^\]]*\]", " ", name.replace("~?", " "))))))


def names() -> list[Name]:
    """All names in order. A name of one short word is none by itself, it needs a form around it."""
    made = []
    for label, identifiers, texts in LICENSES:
        for text in texts:
            pattern = text.replace("~?", f"(?:{_GAP})?").replace("~", _GAP).replace("@", _VERSION)
            forms = ("field", "grant", "reference", "name") if len(text) > 5 else ("field", "grant")
            made.append((label, _needs(text), pattern, forms))
        for identifier in identifiers:
            made.append((label, ("spdx",), re.escape(identifier.lower()), ("spdx tag",)))
    for label, form, text in SIGNATURES:
        # The three longest words are gate enough.
        needs = tuple(sorted(sorted(_needs(text.replace("(?!-)", "")), key=len)[-3:]))
        made.append((label, needs, text.replace("(?: ", f"(?:{_LOOSE}").replace(" )?", f"{_LOOSE})?").replace(" ", _LOOSE), (form,)))
    whole = r"(?i)(?<![0-9A-Za-z])(?:%s)(?![0-9A-Za-z]|\.[0-9])"
    return [Name(label, needs, pattern, whole % pattern, forms) for label, needs, pattern, forms in made]


def rules() -> list[tuple[str, str, int, str]]:
    """Every signature rule as ``(label, form, priority, pattern)``: each name in each of its forms."""
    return [
        (n.label, form, priority, f"(?i){before}" + n.pattern.removeprefix("(?i)"))
        for n in names() for form, priority, before in FORMS if form in n.forms
    ]


#: Words that open the gate for the names that need them; a name that needs none of them opens it by the longest word it needs.
_COMMON = ("licen", "spdx", "gpl", "apache", "bsd", "creative", "cc", "mpl", "cddl", "eupl", "public", "wtfpl", "reserved")


def gate_words(every: list[Name]) -> tuple[str, ...]:
    """Any text that a rule can match has one of these in lower case."""
    return tuple(dict.fromkeys(next((w for w in _COMMON if any(w in need for need in n.needs)), max(n.needs, key=len)) for n in every))


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _phrase(phrase: str) -> Column:
    return F.lit(rf"(?i)(?<![^{_MARKS}])" + rf"[{_MARKS}]+".join(phrase.split()) + rf"(?![^{_MARKS}])")


def base_places(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``n_words``, ``n_base``, ``first_word``, ``last_word`` and ``base`` (labels) to rows whose ``text`` is not null."""
    docs = docs.withColumn("n_words", _words(F.col(text)))
    for i, (_, phrase) in enumerate(PHRASES):
        rare = F.col("_low").contains("license") if "license" in phrase else F.col("_low").contains("cc")
        docs = docs.withColumn(f"_around{i}", F.when(rare, F.split(text, _phrase(phrase), -1)))
    found = [F.col(f"_around{i}") for i in range(len(PHRASES))]
    places = [F.coalesce(F.size(F.when(x.isNotNull(), x)) - 1, F.lit(0)).cast("long") for x in found]
    hit = [F.coalesce(F.size(F.when(x.isNotNull(), x)) > 1, F.lit(False)) for x in found]
    first = [F.when(h, _words(F.element_at(x, 1))) for h, x in zip(hit, found)]
    last = [
        F.when(h, F.col("n_words") - _words(F.element_at(x, -1)) - len(phrase.split()))
        for h, x, (_, phrase) in zip(hit, found, PHRASES)
    ]
    labels = F.array_compact(F.array(*[F.when(h, F.lit(label)) for h, (label, _) in zip(hit, PHRASES)]))
    total = sum(places[1:], places[0])
    return docs.withColumns({
        "n_base": total, "first_word": F.least(*first), "last_word": F.greatest(*last), "base": F.array_sort(labels)
    }).drop(*[f"_around{i}" for i in range(len(PHRASES))])


_NAMES = "array<struct<label: string, needs: array<string>, gate: string, pattern: string, forms: array<string>>>"
_DETECTION = "array<struct<start: int, end: int, label: string, form: string, priority: int>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before_each(items: Column, zero: Column, step: Callable, join: Callable) -> Column:
    """For each item, the state that the items before it lead to from ``zero``; ``join`` puts two states together.

    States of chunks are put together first, so that arrays which grow item by item stay short.
    """

    def running(part: Column, first: Column, step: Callable) -> Column:
        start = F.struct(first.alias("now"), F.slice(F.array(first), 1, 0).alias("found"))
        return F.aggregate(part, start, lambda s, x: F.struct(
            step(s["now"], x).alias("now"), F.concat(s["found"], F.array(s["now"])).alias("found")
        ))["found"]

    def by_chunk(every: Column) -> Column:
        last = F.floor((F.size(every) - 1) / _CHUNK).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), last), lambda j: F.slice(every, j * _CHUNK + 1, F.lit(_CHUNK)))
        return _let(chunks, lambda parts: F.flatten(F.zip_with(
            parts, running(F.transform(parts, lambda c: F.aggregate(c, zero, step)), zero, join), lambda c, first: running(c, first, step)
        )))

    return _let(items, lambda every: F.when(F.size(every) > 0, by_chunk(every)).otherwise(F.slice(F.array(zero), 1, 0)))


def _matches(text: Column, name: Column) -> Column:
    """Intervals of one name in each form that stands around it: lengths of matches and of what lies between add up to places."""

    def pairs(texts: Column) -> Column:
        gaps = F.zip_with(F.split(text, name["pattern"], -1), F.concat(F.array(F.lit("")), texts), lambda gap, earlier: F.struct(
            F.length(gap).alias("gap"), F.right(F.concat(earlier, gap), F.lit(_CONTEXT)).alias("before")
        ))
        sized = F.zip_with(gaps, texts, lambda g, match: F.struct(g["gap"].alias("gap"), g["before"].alias("before"), F.length(match).alias("size")))
        return F.filter(sized, lambda p: p["size"].isNotNull())

    def placed(found: Column) -> Column:
        starts = _before_each(found, F.lit(0), lambda upto, p: upto + p["gap"] + p["size"], lambda a, b: a + b)
        return F.zip_with(found, starts, lambda p, upto: F.struct(
            (upto + p["gap"]).alias("start"), (upto + p["gap"] + p["size"]).alias("end"), p["before"].alias("before")
        ))

    places = _let(_let(F.regexp_extract_all(text, name["pattern"], F.lit(0)), pairs), placed)

    def in_forms(at: Column) -> Column:
        before = at["before"]

        def one(form: str, priority: int, pattern: str) -> Column:
            length = F.length(F.regexp_extract(before, rf"(?i)(?<![0-9A-Za-z]){pattern}$", 0)) if pattern else F.lit(0)
            fits = F.array_contains(name["forms"], form) & (length > 0 if pattern else F.lit(True))
            return F.when(fits, F.struct(
                (at["start"] - length).alias("start"), at["end"].alias("end"), name["label"].alias("label"),
                F.lit(form).alias("form"), F.lit(priority).alias("priority"),
            ))

        return F.array_compact(F.array(*[one(*form) for form in FORMS])).cast(_DETECTION)

    return F.flatten(F.transform(places, in_forms))


def _unsuppressed(found: Column) -> Column:
    """What lies in no interval of at least its priority; of equal intervals of one priority, the first rule's.

    Intervals are swept by start, longer ones first. For each priority the furthest end so far, of it and those above, tells
    whether an interval lies within an earlier one.
    """
    levels = sorted(priority for _, priority, _ in FORMS)
    key = F.transform(found, lambda d, i: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("back"), (-d["priority"]).alias("low"), i.alias("i"), d.alias("d")
    ))
    nothing = F.array(*[F.lit(0)] * len(levels))

    def level(x: Column) -> Column:
        return F.array_position(F.array(*[F.lit(p) for p in levels]), x["d"]["priority"]).cast("int")

    def further(ends: Column, x: Column) -> Column:
        return F.transform(ends, lambda e, i: F.when(i < level(x), F.greatest(e, x["d"]["end"])).otherwise(e))

    def furthest(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.greatest(x, y))

    def outer(ordered: Column) -> Column:
        ends = _before_each(ordered, nothing, further, furthest)
        seen = F.zip_with(ordered, ends, lambda x, e: F.when(F.element_at(e, level(x)) < x["d"]["end"], x["d"]))
        return F.array_compact(seen)

    return _let(F.array_sort(key), outer)


def licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base phrases and the detections of the rules.

    Adds ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` and ``detections``: for each that stands,
    ``start`` (included) and ``end`` (not) in characters of the text, label, form and priority. The score is the highest
    priority over the highest there is, 1 for a base phrase. Null text counts as empty: no words, no labels, score 0. Rows are
    handled each by itself, so repeated rows and ids give repeated results; columns of the same names are replaced, others pass.
    Very long texts are scanned whole.
    """
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
    kept = [c for c in docs.columns if c not in added]
    every = names()
    keywords = sorted({k for n in every for k in n.needs})
    # One literal that Spark folds, in place of thousands of expressions.
    table = F.from_json(F.lit(json.dumps([asdict(n) for n in every])), _NAMES)
    rows = docs.select(*kept).withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = rows.withColumn("_low", F.lower("_text"))
    gate = F.lit(False)
    for word in gate_words(every):
        gate = gate | F.col("_low").contains(word)
    rows = base_places(rows, "_text").withColumn("_gate", gate)
    has = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(F.col("_low"), k))
    rows = rows.withColumn("_has", F.when(F.col("_gate"), has))
    tried = F.filter(table, lambda n: F.forall(n["needs"], lambda k: F.array_contains(F.col("_has"), k)))
    tried = F.filter(tried, lambda n: F.regexp_like(F.col("_low"), n["gate"]))
    found = F.flatten(F.transform(tried, lambda n: _matches(F.col("_text"), n)))
    # Generators of one row each: what they yield is computed once, however often it is used above them.
    rows = rows.select("*", F.explode(F.array(F.when(F.col("_gate"), found))).alias("_found"))
    stand = F.coalesce(F.when(F.size("_found") > 0, _unsuppressed(F.col("_found"))), F.array().cast(_DETECTION))
    rows = rows.select("*", F.explode(F.array(stand)).alias("detections"))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("detections", lambda d: d["label"]))))
    top = F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])), F.lit(0)) / max(p for _, p, _ in FORMS)
    return rows.select(
        *kept, "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(top.cast("double")).alias("score"),
        "detections",
    )
