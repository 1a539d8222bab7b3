"""License scans with Spark expressions only.

A text's units (its lines, its paragraphs, and the whole of it) are normalised to lower-case words of ASCII letters and digits;
units of equal words count once. Units of few enough words meet the templates of short notices by the Dice coefficient over distinct word bigrams, twice those that both have over
those of either. Sizes a and b allow a coefficient of at most ``2 min(a, b) / (a + b)``, so a unit only meets the templates
whose sizes allow ``threshold``.

Notices with other words beside them, over several lines or behind comment signs, and whole licence texts are found in windows
over the words of the whole text, as long as the template. A window of which the coefficient reaches the threshold shares all
but m bigrams of the template, so it holds one of any m + 1 of them: its signs, the longest and so rarest bigrams. Only texts
that hold a sign are looked at, and a window is laid where a sign in the text and the same sign in the template lie on each other.

Null and empty texts have no unit. Repeated rows are scanned each. No shuffle.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices by which texts declare a licence.
TEMPLATES: list[tuple[str, str]] = [
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("mit", "Released under the MIT License."),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Licence texts, and the notices that their authors ask to be put into files; only windows meet them.
TEXTS: list[tuple[str, str]] = [
    ("agpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache-2.0-text", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("bsd-2-clause-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("bsd-3-clause-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("bsd-conditions", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsl-1.0-text", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."),
    ("gpl-2.0-header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl-text", "When we speak of free software, we are referring to freedom, not price. Our General Public Licenses are designed to make sure that you have the freedom to distribute copies of free software (and charge for them if you wish), that you receive source code or can get it if you want it, that you can change the software or use pieces of it in new free programs, and that you know you can do these things."),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("lgpl-header", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("mpl-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense-text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain."),
    ("zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
]
THRESHOLD = 0.8


def bigrams_of(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def signs_of(grams: list[str], threshold: float) -> list[str]:
    """Bigrams of which a set that reaches the threshold with ``grams`` has one: the longest, as they are rare."""
    return sorted(grams, key=lambda g: (-len(g), g))[: len(grams) - bounds(len(grams), threshold)[0] + 1]


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Sizes of sets that can reach the threshold with a set of ``size``."""
    share = Fraction(str(threshold))
    return math.ceil(size * share / (2 - share)), math.floor(size * (2 - share) / share)


def _words(text: Column) -> Column:
    """The lower-case ASCII words of a text."""
    return F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("([a-z0-9]+)"))


def _bigrams(words: Column) -> Column:
    n = F.size(words) - 1
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def scan(df: DataFrame, doc: str, text: str, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, texts: list[tuple[str, str]] = TEXTS) -> DataFrame:
    """doc_id, n_matches (units that reach the threshold with some notice of ``templates``, and templates and texts that only
    windows reach it with), license and dice of the best match (ties: the first by name) and the names of all, null where there
    is none; a row for each row."""
    known = [(name, grams, *bounds(len(grams), threshold)) for name, grams in ((n, bigrams_of(t)) for n, t in sorted(templates)) if grams]
    table = F.array(*[F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, g)).alias("grams"), F.lit(low).alias("low"), F.lit(high).alias("high")) for n, g, low, high in known])
    least = min((k[2] for k in known), default=1)
    most = max((k[3] for k in known), default=0)

    sought = []
    for name, body in sorted([*templates, *texts]):
        if grams := bigrams_of(body):
            words = re.findall("[a-z0-9]+", body.lower())
            every = [f"{a} {b}" for a, b in zip(words, words[1:])]
            chosen = signs_of(grams, threshold)
            sought.append((name, grams, len(every), chosen, [every.index(g) for g in chosen]))
    of_all = lambda values: F.array(*map(F.lit, values))
    windows = F.array(*[F.struct(F.lit(n).alias("name"), of_all(g).alias("grams"), F.lit(size).alias("long"), of_all(chosen).alias("signs"), of_all(at).alias("at")) for n, g, size, chosen, at in sought])
    signs = of_all(sorted({sign for *_, chosen, _ in sought for sign in chosen}))

    lines, blocks = F.split("text", "\n"), F.split("text", "\n[ \\t\\r]*\n")
    units = F.array_distinct(F.transform(F.concat(lines, blocks, F.array("text")), lambda u: F.array_join(_words(u), " ")))

    def matches(grams: Column) -> Column:
        allowed = F.filter(table, lambda t: F.size(grams).between(t.low, t.high))
        scored = F.transform(allowed, lambda t: F.struct((F.lit(2.0) * F.size(F.array_intersect(grams, t.grams)) / (F.size(grams) + F.size(t.grams))).alias("dice"), t["name"].alias("name")))
        return F.filter(scored, lambda s: s.dice >= threshold)

    def best_window(t: Column) -> Column:
        """The coefficient of the best window of a template (null without one), over the places of signs in the text."""
        own = F.filter("places", lambda p: F.array_contains(t.signs, F.element_at("grams", p)))
        starts = F.array_distinct(F.transform(own, lambda p: F.greatest(F.lit(1), p - F.element_at(t.at, F.array_position(t.signs, F.element_at("grams", p)).cast("int")))))
        held = F.transform(starts, lambda p: F.array_distinct(F.slice("grams", p, t.long)))
        scored = F.transform(held, lambda w: F.lit(2.0) * F.size(F.array_intersect(w, t.grams)) / (F.size(w) + F.size(t.grams)))
        return F.struct(F.array_max(scored).alias("dice"), t["name"].alias("name"))

    none = lambda kind: F.array().cast(f"array<{kind}>")
    no_match = none("struct<dice:double,name:string>")

    # Each step is a column of its own, so that it is evaluated once and not again for every element of the next; one that only a
    # lambda of the next step read would still be.
    rows = df.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", _words(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "text", F.when(F.size("words") > 1, _bigrams(F.col("words"))).otherwise(none("string")).alias("grams"))
    rows = rows.select("doc_id", "text", "grams", F.array_intersect("grams", signs).alias("held"))
    # The bigrams of a unit are bigrams of the text, so a text without signs has no match in units either.
    signed = F.size("held") > 0
    places = F.filter(F.sequence(F.lit(1), F.size("grams")), lambda i: F.array_contains("held", F.element_at("grams", i)))
    rows = rows.select("doc_id", "held", F.when(signed, units).otherwise(none("string")).alias("units"), F.when(signed, F.col("grams")).otherwise(none("string")).alias("grams"), F.when(signed, places).otherwise(none("int")).alias("places"))
    split = F.filter(F.transform("units", lambda u: F.split(u, " ")), lambda w: F.size(w).between(least + 1, most + 1))
    rows = rows.select("doc_id", "held", "grams", "places", F.transform(split, lambda w: F.array_distinct(_bigrams(w))).alias("units"))
    more = F.filter(F.transform(F.filter(windows, lambda t: F.arrays_overlap(t.signs, F.col("held"))), best_window), lambda s: s.dice >= threshold)
    rows = rows.select("doc_id", F.filter(F.transform("units", matches), lambda m: F.size(m) > 0).alias("found"), F.when(signed & (F.size("places") > 0), more).otherwise(no_match).alias("more"))
    rows = rows.select("doc_id", F.size("found").cast("long").alias("n_matches"), F.flatten("found").alias("found"), "more")
    known_names = F.transform("found", lambda s: s["name"])
    rows = rows.select("doc_id", "n_matches", "found", F.filter("more", lambda s: ~F.array_contains(known_names, s["name"])).alias("more"))
    rows = rows.select("doc_id", (F.col("n_matches") + F.size("more")).alias("n_matches"), F.concat("found", "more").alias("found"))
    rows = rows.select("doc_id", "n_matches", "found", F.array_max(F.transform("found", lambda s: s.dice)).alias("dice"))
    name = F.array_min(F.transform(F.filter("found", lambda s: s.dice == F.col("dice")), lambda s: s["name"]))
    every = F.array_join(F.sort_array(F.array_distinct(F.transform("found", lambda s: s["name"]))), ",")
    return rows.select("doc_id", "n_matches", name.alias("license"), "dice", F.when(F.size("found") > 0, every).alias("licenses"))
