"""License scans: Dice coefficient over word bigrams against license templates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.staging import col

# Parts that several license texts share.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE."
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.\n\nYou should have "
    "received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
)

#: Notices, headers and license texts as their publishers word them; paragraphs are parted by blank lines.
TEMPLATES: dict[str, str] = {
    "MIT text": f"{_MIT}\n\n{_AS_IS}",
    "MIT-0 text": _MIT.split(", subject to")[0] + f".\n\n{_AS_IS}",
    "ISC text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND '
    "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause text": _REDISTRIBUTION + _BSD_DISCLAIMER,
    "BSD-3-Clause text": _REDISTRIBUTION
    + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
    "specific prior written permission.\n\n" + _BSD_DISCLAIMER,
    "Zlib text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the "
    "use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it "
    "freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If "
    "you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly "
    "marked as such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source distribution.",
    "Unlicense text": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this "
    "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright "
    "laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the "
    "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future "
    f"rights to this software under copyright law.\n\n{_AS_IS.split(' OR COPYRIGHT HOLDERS')[0]} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to <https://unlicense.org>",
    "GPL-3.0 header": _GNU.format(name="General Public License"),
    "AGPL-3.0 header": _GNU.format(name="Affero General Public License"),
    "LGPL-3.0 header": _GNU.format(name="Lesser General Public License"),
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the '
    "License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "
    '"AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.',
    "CC0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}

#: Least Dice coefficient, as a fraction of whole numbers so that it is compared exactly.
DICE = (8, 10)
#: Most paragraphs of a run that is compared as one unit.
RUN_PARAGRAPHS = 8
#: Words that serve to find documents: long ones, which are rare in other texts, and shorter ones only where those are too few. The
#: shortest ones are looked for as whole words.
ANCHOR_LETTERS, WHOLE = (8, 6, 5, 2), 5


def words_of(text: str) -> list[str]:
    cleaned = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
    return cleaned.split()


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def anchors(bigrams: list[str], dice: tuple[int, int]) -> list[str]:
    """Words of which a text must hold one to reach the coefficient with a template.

    Such a text lacks at most (2 - 2d) / (2 - d) of the template's bigrams, so it holds one of any larger set of them,
    and with it that bigram's words. Words are picked until the bigrams that hold one are such a set.
    """
    over, under = dice
    lacking = len(bigrams) * (2 * under - 2 * over) / (2 * under - over)
    for letters in ANCHOR_LETTERS:
        open_, picked = list(bigrams), []
        while len(bigrams) - len(open_) <= lacking:
            counts: dict[str, int] = {}
            for pair in open_:
                for w in set(pair.split()):
                    if len(w) >= letters:
                        counts[w] = counts.get(w, 0) + 1
            if not counts:
                break
            best = max(counts, key=lambda w: (counts[w], len(w), w))
            picked.append(best)
            open_ = [p for p in open_ if best not in p.split()]
        else:
            return picked
    return [""]  # no such set: every text may match


def _words(text: Column) -> Column:
    """Words of a text in lower case."""
    return F.filter(F.split(text, "[^a-z0-9]+"), lambda w: w != "")


def _words_in(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x["n"])


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, dice: tuple[int, int] = DICE) -> DataFrame:
    """``doc_id, unit, unit_no, license, shared, unit_bigrams, template_bigrams, dice``: every match.

    Units of a text: the whole (``unit_no`` 0), its paragraphs (parted by blank lines) and its lines, the latter two if
    there are several, numbered from 1; and runs of 2 to ``RUN_PARAGRAPHS`` neighbouring paragraphs (unit ``run n``, numbered by
    their first), which find a license of several paragraphs within a longer text. Runs are compared with templates of several paragraphs. A unit is lower-cased, all but a-z and 0-9 taken as space, and its distinct
    word bigrams compared with each template's: 2 * shared / (unit + template) of at least ``dice``. Templates whose
    size alone rules that out are not compared; before that, a text without any of a template's anchor words is passed over.

    The templates are few and given in code, so they travel as literals; nothing is shuffled. Null, empty and one-word
    texts match nothing; so do templates of one word. Repeated rows match each for itself, null ids stay null. Equal
    scores are all returned. No rows: no rows. Other columns are left out, so they cannot clash.
    """
    over, under = dice
    known = {name: pairs for name, pairs in ((n, bigrams_of(t)) for n, t in templates.items()) if pairs}
    schema = "doc_id bigint, unit string, unit_no int, license string, shared int, unit_bigrams int, template_bigrams int, dice double"
    if not known:
        return docs.sparkSession.createDataFrame([], schema)
    hints = sorted({w for pairs in known.values() for w in anchors(pairs, dice)})
    tests = [f"contains(text, '{w}')" for w in hints if len(w) >= WHOLE or not w]
    if short := [w for w in hints if 0 < len(w) < WHOLE]:
        tests.append(f"text RLIKE '(?<![a-z0-9])({'|'.join(short)})(?![a-z0-9])'")
    found = docs.select(col("doc_id").alias("doc_id"), F.explode(F.array(F.lower(col("text")))).alias("text")).where(F.expr(" OR ".join(tests)))
    long = {name for name, text in templates.items() if "\n\n" in text}

    def units(kind: str, pattern: str) -> Column:
        parts = F.split("text", pattern, -1)
        numbered = F.transform(parts, lambda x, i: F.struct(F.lit(kind).alias("unit"), (i + 1).alias("unit_no"), x.alias("body")))
        return F.when(F.size(parts) > 1, numbered).otherwise(F.slice(numbered, 1, 0))

    whole = F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("unit_no"), F.col("text").alias("body")))
    # the fewest words that a run needs to reach the coefficient with any long template
    fewest = 1 + min((len(known[n]) * over // (2 * under - over) for n in long if n in known), default=1 << 30)
    parts = F.split("text", "\n[ \t\r]*\n", -1)
    counted = F.transform(parts, lambda x: F.struct(x.alias("body"), F.regexp_count(x, F.lit("[a-z0-9]+")).alias("n")))
    found = found.select("*", F.explode(F.array(counted)).alias("parts"))

    def runs(n: int) -> Column:
        """Runs of ``n`` paragraphs that have words enough."""
        starts = F.filter(F.sequence(F.lit(1), F.size("parts") - n + 1), lambda i: _words_in(F.slice("parts", i, n)) >= fewest)
        body = lambda i: F.array_join(F.transform(F.slice("parts", i, n), lambda x: x["body"]), "\n")
        made = F.transform(starts, lambda i: F.struct(F.lit(f"run {n}").alias("unit"), i.alias("unit_no"), body(i).alias("body")))
        return F.when(F.size("parts") >= n, made).otherwise(F.slice(whole, 1, 0))

    several = [runs(n) for n in range(2, RUN_PARAGRAPHS + 1)]
    rows = found.select("doc_id", F.inline(F.concat(whole, units("paragraph", "\n[ \t\r]*\n"), units("line", "\n"), *several)))
    rows = rows.select("doc_id", "unit", "unit_no", F.explode(F.array(_words(F.col("body")))).alias("w")).where(F.size("w") > 1)
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.get("w", i - 1), F.get("w", i)))
    rows = rows.select("doc_id", "unit", "unit_no", F.explode(F.array(F.array_distinct(pairs))).alias("pairs"))
    rows = rows.withColumn("unit_bigrams", F.size("pairs"))

    def fits(size: int) -> Column:
        a = F.col("unit_bigrams")
        return under * 2 * F.least(a, F.lit(size)) >= over * (a + size)

    is_run = F.col("unit").startswith("run")

    compared = F.array(
        *[
            F.when(
                fits(len(ps)) if name in long else fits(len(ps)) & ~is_run,
                F.struct(
                    F.lit(name).alias("license"),
                    F.size(F.array_intersect("pairs", F.array(*[F.lit(p) for p in ps]))).alias("shared"),
                    F.lit(len(ps)).alias("template_bigrams"),
                ),
            )
            for name, ps in known.items()
        ]
    )
    matches = rows.select("doc_id", "unit", "unit_no", "unit_bigrams", F.inline(F.filter(compared, lambda m: m.isNotNull())))
    total = F.col("unit_bigrams") + F.col("template_bigrams")
    matches = matches.where(under * 2 * F.col("shared") >= over * total)
    return matches.select("doc_id", "unit", "unit_no", "license", "shared", "unit_bigrams", "template_bigrams", (2 * F.col("shared") / total).alias("dice"))
