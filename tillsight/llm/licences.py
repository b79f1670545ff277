"""Licence notices, recognised sentence by sentence.

Comment marks are taken off, and a text is cut into paragraphs: at blank lines, at list items, and where a line ends in a
colon.  Wrapped lines of a paragraph belong together; its sentences are cut at full stops and normalised: lower case,
letters and digits only, single spaces.  A fixed table maps normalised sentences to identifiers; a long sentence of the
table also counts inside a longer one, as where a notice is run together with its title.  A paragraph without any known
sentence is tried line by line, since a notice may stand on a line between others.  A rule is an ordered row of
identifiers, and a document matches a rule where the identifiers of consecutive known sentences of the document contain
it.  The longest rule at a place wins.

Defined results: null and empty texts have no notices; a document without any known sentence is listed with an empty
array; repeated rows are listed each; only id and text are read, so other columns may clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.llm.tables import let

# Sentences of public licence texts and notices, as published, with their identifiers.
SENTENCES = {
    "mit-name": ("The MIT License", "MIT License", "The MIT License (MIT)"),
    "mit-released": ("Released under the MIT License", "Licensed under the MIT License",
                     "This project is licensed under the MIT License", "Distributed under the MIT License",
                     "This work is licensed under the MIT License"),
    "mit-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                  "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                  "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                  "following conditions",),
    "mit-notice": ("The above copyright notice and this permission notice shall be included in all copies or substantial "
                   "portions of the Software",),
    "as-is": ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
              "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",),
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
                  "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    "apache2-licensed": ("Licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0",
                         "This work is licensed under the Apache License, Version 2.0",
                         "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    "apache2-comply": ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                       "compliance with the License",),
    "apache2-obtain": ("You may obtain a copy of the License at", "You may obtain a copy of the License at "
                       "http://www.apache.org/licenses/LICENSE-2.0"),
    "apache2-basis": ("Unless required by applicable law or agreed to in writing, software distributed under the License is "
                      "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                      "implied",),
    "gpl3-licensed": ("This work is licensed under the GNU General Public License, version 3",
                      "Licensed under the GNU General Public License version 3",
                      "Released under the GNU General Public License version 3"),
    "gpl2-licensed": ("This work is licensed under the GNU General Public License, version 2",
                      "Licensed under the GNU General Public License version 2"),
    "gpl3-free": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                  "option) any later version",),
    "gpl2-free": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                  "option) any later version",),
    "lgpl3-free": tuple(f"This {x} is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                        "or (at your option) any later version" for x in ("program", "library")),
    "lgpl21-free": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                    "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
                    "or (at your option) any later version",),
    "agpl3-free": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                   "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                   "(at your option) any later version",),
    "gpl-hope": tuple(f"This {x} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                      "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE" for x in ("program", "library")),
    "lgpl3-licensed": ("Licensed under the GNU Lesser General Public License version 3",),
    "agpl3-licensed": ("Licensed under the GNU Affero General Public License version 3",),
    "bsd-redistribution": ("Redistribution and use in source and binary forms, with or without modification, are permitted "
                           "provided that the following conditions are met",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer",),
    "bsd-binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution",),
    "bsd-endorse": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                    "promote products derived from this software without specific prior written permission",),
    "mpl2-subject": ("This Source Code Form is subject to the terms of the Mozilla Public License, v",),
    "mpl2-version": ("2.0",),
    "cc-by-nc4-licensed": ("Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0",
                           "Released under CC BY-NC 4.0"),
    "cc-by4-licensed": ("Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0"),
    "cc-by-sa4-licensed": ("Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0"),
    "cc0-licensed": ("Released under CC0 1.0", "Licensed under CC0 1.0"),
    "cc0-dedicated": tuple(f"To the extent possible under law, the {x} dedicated all copyright and related and neighboring rights "
                           "to this software to the public domain worldwide" for x in ("author(s) have", "author has")),
    "reserved": ("All rights reserved",),
}

# Ordered rules, each the identifiers that make up a notice.
RULES = {
    "MIT": (("mit-name", "mit-grant", "mit-notice", "as-is"), ("mit-grant", "mit-notice", "as-is"), ("mit-released",),
            ("mit-grant", "mit-notice")),
    "ISC": (("isc-grant",),),
    "Apache-2.0": (("apache2-comply", "apache2-obtain", "apache2-basis"), ("apache2-comply", "apache2-obtain"),
                   ("apache2-comply",), ("apache2-licensed",)),
    "GPL-3.0": (("gpl3-free", "gpl-hope"), ("gpl3-licensed",), ("gpl3-free",)),
    "GPL-2.0": (("gpl2-free", "gpl-hope"), ("gpl2-licensed",), ("gpl2-free",)),
    "LGPL-3.0": (("lgpl3-free", "gpl-hope"), ("lgpl3-free",), ("lgpl3-licensed",)),
    "LGPL-2.1": (("lgpl21-free", "gpl-hope"), ("lgpl21-free",)),
    "AGPL-3.0": (("agpl3-free", "gpl-hope"), ("agpl3-free",), ("agpl3-licensed",)),
    "BSD-3-Clause": (("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"),),
    "BSD-2-Clause": (("bsd-redistribution", "bsd-source", "bsd-binary"),),
    "MPL-2.0": (("mpl2-subject", "mpl2-version"),),
    "CC-BY-NC-4.0": (("cc-by-nc4-licensed",),),
    "CC-BY-4.0": (("cc-by4-licensed",),),
    "CC-BY-SA-4.0": (("cc-by-sa4-licensed",),),
    "CC0-1.0": (("cc0-licensed",), ("cc0-dedicated",)),
    "Proprietary": (("reserved",),),
}

# Replacements that leave a text as paragraphs with a blank line between: line ends, comment marks, list items, colons.
CLEANED = ((r"\r\n?", "\n"), (r"[ \t]*\*+/[ \t]*(\n|$)", "$1"),
           (r"(^|\n)[ \t]*(?:/\*+|//+|#+|;+|%+|--+|\*+)[ \t]*", "$1"),
           (r"(^|\n)[ \t]*(?:[0-9]+[.)]|[-+]|\([a-z0-9]\))[ \t]+", "\n\n"), (r":[ \t]*\n", ":\n\n"))
PARAGRAPH_END = r"\n(?:[ \t]*\n)+"
SENTENCE_END = r"[.!?][ \t\n\f]+"
# Within a line of a paragraph that has no known sentence.
LINE_END = r"[.!?;:][ \t\f]+|\n"

# A paragraph with a known sentence holds one of these.
HINT = r"(?i)licen[sc]e|permission|redistribut|software|reserved|mozilla|warrant|cc by|cc0|rights"

# Sentences of so many characters, normalised, are also found inside longer ones.
LONG = 100


def _plain(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def known_sentences() -> list[tuple[str, str]]:
    """(normalised sentence, identifier)."""
    return [(_plain(t), ident) for ident, texts in SENTENCES.items() for t in texts]


def rules() -> list[tuple[str, tuple[str, ...]]]:
    """(licence, identifiers), longest first."""
    listed = [(name, ids) for name, all_ids in RULES.items() for ids in all_ids]
    return sorted(listed, key=lambda r: (-len(r[1]), r))


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def paragraphs(text: Column) -> Column:
    cleaned = F.coalesce(text, F.lit(""))
    for found, put in CLEANED:
        cleaned = F.regexp_replace(cleaned, found, put)
    return F.split(cleaned, PARAGRAPH_END)


def _identified(parts: Column) -> Column:
    """Identifiers of some sentences, in order; of several inside one sentence, by place."""
    known = known_sentences()
    exact = F.create_map(*[F.lit(x) for pair in known for x in pair])
    inner = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, i in known if len(t) >= LONG])
    shortest = min(len(t) for t, _ in known)

    def of(s: Column) -> Column:
        whole = F.element_at(exact, s)
        inside = F.transform(F.filter(inner, lambda k: F.contains(s, k["t"])), lambda k: F.struct(F.instr(s, k["t"]).alias("at"), k["i"].alias("i")))
        several = F.transform(F.array_sort(inside), lambda k: k["i"])
        return F.when(F.length(s) < shortest, none).when(whole.isNotNull(), F.array(whole)).when(F.length(s) > LONG, several).otherwise(none)

    none = F.array().cast("array<string>")
    return F.flatten(F.transform(parts, lambda p: let(normalised(p), of)))


def _matches(ids: Column) -> Column:
    """Licences of the rules found in a row of identifiers, in order: the rules become one pattern, longest first."""
    numbered = rules()
    pattern = "|".join(f"({''.join(f'{i} ' for i in ids)})" for _, ids in numbered)
    joined = F.concat(F.array_join(ids, " "), F.lit(" "))
    names = F.create_map(*[F.lit(x) for name, found in numbered for x in ("".join(f"{i} " for i in found), name)])
    return F.transform(F.regexp_extract_all(joined, F.lit(pattern), F.lit(0)), lambda m: F.element_at(names, m))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, licences, sentence_ids, n_sentences) for every row."""
    none = F.array().cast("array<string>")

    def known(paragraph: Column) -> Column:
        together = _identified(F.split(paragraph, SENTENCE_END))
        by_line = let(together, lambda ids: F.when((F.size(ids) > 0) | ~F.contains(paragraph, F.lit("\n")), ids).otherwise(
            _identified(F.split(paragraph, LINE_END))))
        return F.when(F.rlike(paragraph, F.lit(HINT)), by_line).otherwise(none)

    def found(parts: Column) -> Column:
        sizes = F.transform(parts, lambda p: F.size(F.filter(F.split(p, SENTENCE_END), lambda s: F.rlike(s, F.lit("[A-Za-z0-9]")))))
        return F.struct(F.flatten(F.transform(parts, known)).alias("ids"),
                        F.aggregate(sizes, F.lit(0).cast("long"), lambda n, x: n + x).alias("n"))

    out = docs.select(id_col, let(paragraphs(docs[text_col]), found).alias("f"))
    return out.select(id_col, _matches(F.col("f.ids")).alias("licences"), F.col("f.ids").alias("sentence_ids"),
                      F.col("f.n").alias("n_sentences"))
