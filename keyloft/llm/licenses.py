"""License scans by ordered signature rules.

A text is reduced to its words, one space between them. Keywords are looked for first, all at once;
only rules whose keyword occurs are tried. What they find competes: in order of priority, then
length, a finding stands unless it lies inside one that stands already, or encloses one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ALNUM, load

#: Phrases whose places are counted whatever the rules find, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Rule:
    """A signature: `pattern` over lower-cased words parted by single spaces, tried if `keyword` occurs.

    Every text that the pattern matches has the keyword, whichever alternative it takes.
    """

    label: str
    keyword: str
    pattern: str
    priority: int
    score: float


#: Hand-written families: label, keyword, the name as words, versions as words (empty: none).
#: A version's words are those of its number: 2.0 is "2 0", v3 is "v3".
FAMILIES = [
    ("gpl", "gnu", r"gnu (?:general public license|gpl)", "1 0|2 0|2|3 0|3|v1|v2|v3"),
    ("gpl", "gpl", r"gplv?", "1 0|1|2 0|2|3 0|3|v1|v2|v2 0|v3|v3 0"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license", "2 0|2 1|2|3 0|3|v2 1|v3"),
    ("lgpl", "library general", r"(?:gnu )?library general public license", "2 0|2 1|2|3 0|3|v2|v2 0|v2 1|v3"),
    ("lgpl", "lgpl", r"lgplv?", "2 0|2 1|2|3 0|3|v2|v2 0|v2 1|v3|v3 0"),
    ("agpl", "affero", r"(?:gnu )?affero general public license", "1 0|3 0|3|v3"),
    ("agpl", "agpl", r"agplv?", "1 0|1|3 0|3|v1|v3|v3 0"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation license", "1 1|1 2|1 3"),
    ("apache", "apache", r"apache (?:software )?license", "1 0|1 1|2 0|2|v2"),
    ("mit", "mit", r"mit license", ""),
    ("x11", "x11", r"x11 license", ""),
    ("expat", "expat", r"expat license", ""),
    ("bsd", "bsd", r"bsd (?:style )?license", ""),
    ("bsd-2-clause", "bsd", r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd) license", ""),
    ("bsd-3-clause", "bsd", r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|new bsd|modified bsd) license", ""),
    ("bsd-4-clause", "bsd", r"(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd) license", ""),
    ("0bsd", "0bsd", r"0bsd(?: license)?", ""),
    ("isc", "isc", r"isc license", ""),
    ("mpl", "mozilla", r"mozilla public license", "1 0|1 1|2 0|2|v2"),
    ("epl", "eclipse", r"eclipse public license", "1 0|2 0|v1|v2"),
    ("edl", "eclipse", r"eclipse distribution license", "1 0"),
    ("cddl", "development", r"common development and distribution license", "1 0|1 1"),
    ("cpl", "common", r"common public license", "0 5|1 0"),
    ("eupl", "european", r"european union public licen[cs]e", "1 0|1 1|1 2"),
    ("artistic", "artistic", r"artistic license", "1 0|2 0"),
    ("boost", "boost", r"boost software license", "1 0"),
    ("zlib", "zlib", r"zlib(?: libpng)? license", ""),
    ("libpng", "libpng", r"libpng license", "2 0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ""),
    ("wtfpl", "wtfpl", r"wtfpl", "2 0|2"),
    ("python", "python", r"python (?:software foundation )?license", "2 0|2"),
    ("ruby", "ruby", r"ruby license", ""),
    ("php", "php", r"php license", "3 0|3 01"),
    ("postgresql", "postgresql", r"postgresql license", ""),
    ("openssl", "openssl", r"openssl license", ""),
    ("openldap", "openldap", r"openldap public license", "2 7|2 8"),
    ("w3c", "w3c", r"w3c (?:software )?license", ""),
    ("ofl", "open font", r"(?:sil )?open font license", "1 0|1 1"),
    ("odbl", "database", r"open (?:data commons open )?database license", "1 0"),
    ("odc-by", "commons attribution", r"open data commons attribution license", "1 0"),
    ("pddl", "public domain dedication", r"(?:open data commons )?public domain dedication and license", "1 0"),
    ("ms-pl", "microsoft", r"microsoft public license", ""),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", ""),
    ("ibm-pl", "ibm", r"ibm public license", "1 0"),
    ("apsl", "apple", r"apple public source license", "1 0|1 1|1 2|2 0"),
    ("intel", "intel", r"intel open source license", ""),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license", ""),
    ("afl", "academic", r"academic free license", "1 1|1 2|2 0|2 1|3 0"),
    ("osl", "open software", r"open software license", "1 0|1 1|2 0|2 1|3 0"),
    ("upl", "universal", r"universal permissive license", "1 0"),
    ("bsl", "business", r"business source license", "1 0|1 1"),
    ("sspl", "server side", r"server side public license", "1"),
    ("elastic", "elastic", r"elastic license", "1 0|2 0"),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|strict|perimeter) license", "1 0 0"),
    ("openrail", "rail", r"(?:bigscience |creativeml )?open ?rail(?: [ms])? license", "1 0"),
    ("llama", "llama", r"llama [0-9](?: [0-9])? community license(?: agreement)?", ""),
    ("qpl", "public license", r"q public license", "1 0"),
    ("nasa", "nasa", r"nasa open source agreement", "1 3"),
    ("json", "json", r"json license", ""),
    ("beerware", "beer", r"beer ?ware license", ""),
    ("vim", "vim", r"vim license", ""),
    ("curl", "curl", r"curl license", ""),
    ("ecl", "educational", r"educational community license", "1 0|2 0"),
    ("cecill", "cecill", r"cecill", "1 0|1 1|2 0|2 1|b|c"),
    ("mulan", "mulan", r"mulan (?:psl|permissive software license)", "1|2|v1|v2"),
    ("cc0", "cc0", r"cc0", "1 0"),
    ("cc0", "creative commons", r"creative commons (?:cc0|zero)", "1 0"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd", "2 0|2 5|3 0|4 0"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa", "2 0|2 5|3 0|4 0"),
    ("cc-by-nc", "cc by nc", r"cc by nc", "2 0|2 5|3 0|4 0"),
    ("cc-by-nd", "cc by nd", r"cc by nd", "2 0|2 5|3 0|4 0"),
    ("cc-by-sa", "cc by sa", r"cc by sa", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by", "cc by", r"cc by", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative|ativ)e?s?(?: works)?", "3 0|4 0"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike", "3 0|4 0"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial", "3 0|4 0"),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?derivatives", "3 0|4 0"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike", "3 0|4 0"),
    ("cc-by", "creative commons", r"creative commons attribution", "3 0|4 0"),
]

#: Short names as SPDX has them, as words: label, keyword, the id without version, its versions (empty: none),
#: and whether the id says by itself that a license is meant. The others, such as "mit", which is also a
#: German word, count only where the text calls them a license or beside another id.
IDS = [
    ("mit", "mit", "mit", "", False),
    ("mit-0", "mit 0", "mit 0", "", False),
    ("apache", "apache", "apache", "1 0|1 1|2 0|2", True),
    ("bsd", "bsd", "bsd", "", False),
    ("bsd-2-clause", "bsd 2 clause", "bsd 2 clause", "", True),
    ("bsd-3-clause", "bsd 3 clause", "bsd 3 clause", "", True),
    ("bsd-4-clause", "bsd 4 clause", "bsd 4 clause", "", True),
    ("0bsd", "0bsd", "0bsd", "", True),
    ("isc", "isc", "isc", "", False),
    ("mpl", "mpl", "mpl", "1 0|1 1|2 0|2", True),
    ("epl", "epl", "epl", "1 0|2 0", False),
    ("cddl", "cddl", "cddl", "1 0|1 1", True),
    ("cpl", "cpl", "cpl", "1 0", False),
    ("eupl", "eupl", "eupl", "1 0|1 1|1 2", True),
    ("artistic", "artistic", "artistic", "1 0|2 0", True),
    ("boost", "bsl", "bsl", "1 0", True),
    ("bsl", "busl", "busl", "1 1", True),
    ("zlib", "zlib", "zlib", "", False),
    ("libpng", "libpng", "libpng", "2 0", False),
    ("unlicense", "unlicense", "unlicense", "", True),
    ("wtfpl", "wtfpl", "wtfpl", "", True),
    ("x11", "x11", "x11", "", False),
    ("python", "python", "python", "2 0", False),
    ("python", "psf", "psf", "2 0", True),
    ("ruby", "ruby", "ruby", "", False),
    ("php", "php", "php", "3 0|3 01", False),
    ("postgresql", "postgresql", "postgresql", "", False),
    ("openssl", "openssl", "openssl", "", False),
    ("openldap", "oldap", "oldap", "2 7|2 8", True),
    ("w3c", "w3c", "w3c", "", False),
    ("ofl", "ofl", "ofl", "1 0|1 1", True),
    ("odbl", "odbl", "odbl", "1 0", True),
    ("odc-by", "odc by", "odc by", "1 0", True),
    ("pddl", "pddl", "pddl", "1 0", True),
    ("ms-pl", "ms pl", "ms pl", "", True),
    ("ms-rl", "ms rl", "ms rl", "", True),
    ("ibm-pl", "ipl", "ipl", "1 0", False),
    ("apsl", "apsl", "apsl", "1 0|1 1|1 2|2 0", True),
    ("intel", "intel", "intel", "", False),
    ("ncsa", "ncsa", "ncsa", "", False),
    ("afl", "afl", "afl", "1 1|1 2|2 0|2 1|3 0", False),
    ("osl", "osl", "osl", "1 0|1 1|2 0|2 1|3 0", True),
    ("upl", "upl", "upl", "1 0", True),
    ("sspl", "sspl", "sspl", "1 0|1", True),
    ("elastic", "elastic", "elastic", "2 0", False),
    ("gfdl", "gfdl", "gfdl", "1 1|1 2|1 3", True),
    ("qpl", "qpl", "qpl", "1 0", True),
    ("nasa", "nasa", "nasa", "1 3", False),
    ("json", "json", "json", "", False),
    ("vim", "vim", "vim", "", False),
    ("curl", "curl", "curl", "", False),
    ("ecl", "ecl", "ecl", "1 0|2 0", True),
    ("cecill", "cecill", "cecill", "", True),
    ("mulan", "mulanpsl", "mulanpsl", "1 0|2 0", True),
    ("openrail", "openrail", "(?:bigscience |creativeml )?openrail(?: ?[ms])?", "", True),
]

#: Addresses of licenses as words: label, keyword, what follows, versions.
ADDRESSES = [
    ("apache", "apache org", "apache org licenses license", "1 0|1 1|2 0"),
    *((f"cc-{kind}", "creativecommons", f"creativecommons org licenses {kind.replace('-', ' ')}", "1 0|2 0|2 5|3 0|4 0")
      for kind in ("by-nc-nd", "by-nc-sa", "by-nc", "by-nd", "by-sa", "by")),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nd nc", "1 0"),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero", "1 0"),
    ("public-domain", "creativecommons", "creativecommons org (?:publicdomain mark|licenses publicdomain)", "1 0"),
]

#: Hand-written signatures of notices: sentences by which files say what they are under. Label, words.
NOTICES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this file is part of a program that is free software under the gnu general public license"),
    ("gpl", "you should have received a copy of the gnu general public license along with"),
    ("gpl", "either version 2 of the license or at your option any later version"),
    ("gpl", "either version 3 of the license or at your option any later version"),
    ("gpl", "see the gnu general public license for more details"),
    ("gpl", "may be used under the terms of the gnu general public license"),
    ("gpl", "is distributed under the terms of the gnu general public license"),
    ("gpl", "licensed under the gnu gpl"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu library general public license"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license along with"),
    ("lgpl", "see the gnu lesser general public license for more details"),
    ("lgpl", "see the gnu library general public license for more details"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with"),
    ("agpl", "see the gnu affero general public license for more details"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", "a copy of the license is included in the section entitled gnu free documentation license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache", "this product includes software developed by the apache software foundation"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", "the contents of this file are subject to the mozilla public license version"),
    ("mpl", "alternatively the contents of this file may be used under the terms of the mpl"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "are made available under the terms of the eclipse public license"),
    ("edl", "are made available under the terms of the eclipse distribution license"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl", "you can obtain a copy of the license at usr src opensolaris license"),
    ("cpl", "are made available under the terms of the common public license"),
    ("eupl", "licensed under the eupl version"),
    ("eupl", "you may not use this work except in compliance with the licence"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("boost", "see accompanying file license 1 0 txt or copy at"),
    ("bsd", "use of this source code is governed by a bsd style license"),
    ("bsd", "redistributable under the terms of the bsd license"),
    ("bsd-3-clause", "use of this source code is governed by a bsd 3 clause license"),
    ("mit", "use of this source code is governed by an mit style license"),
    ("mit", "this software is released under the mit license"),
    ("mit", "this project is licensed under the terms of the mit license"),
    ("mit", "distributed under the mit software license"),
    ("artistic", "you can redistribute it and or modify it under the same terms as perl itself"),
    ("artistic", "this library is free software you may distribute under the terms of the artistic license"),
    ("artistic", "under the terms of either the gnu general public license or the artistic license"),
    ("afl", "licensed under the academic free license version"),
    ("osl", "licensed under the open software license version"),
    ("ofl", "this font software is licensed under the sil open font license"),
    ("cc-by", "this work is licensed under a creative commons attribution license"),
    ("cc-by", "to view a copy of this license visit http creativecommons org licenses by"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("cc0", "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("odbl", "this database is made available under the open database license"),
    ("odbl", "any rights in individual contents of the database are licensed under the database contents license"),
    ("pddl", "is made available under the public domain dedication and license"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("public-domain", "this file has been put into the public domain"),
    ("public-domain", "this software is in the public domain"),
    ("public-domain", "the author disclaims copyright to this source code"),
    ("public-domain", "the author hereby disclaims copyright"),
    ("public-domain", "has been released into the public domain by its author"),
    ("public-domain", "is a work of the united states government and is not subject to copyright protection"),
    ("proprietary", "this software is proprietary and confidential"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "contains confidential and proprietary information"),
    ("proprietary", "all rights reserved no part of this"),
    ("proprietary", "may not be reproduced in any form without the prior written permission"),
    ("proprietary", "this source code is the confidential property of"),
    ("unknown", "see the license file for the terms"),
    ("unknown", "see the file license for copying permission"),
    ("unknown", "see the file copying for copying conditions"),
    ("unknown", "is subject to the terms and conditions of the license"),
]

#: Hand-written signatures of license bodies: grants, conditions and disclaimers. Label, words.
BODIES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("x11", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"),
    ("ncsa", "to deal with the software without restriction including without limitation the rights"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("bsd", "this software is provided by the regents and contributors as is"),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache", "terms and conditions for use reproduction and distribution 1 definitions license shall mean"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache", "you must give any other recipients of the work or derivative works a copy of this license"),
    ("apache", "if the work includes a notice text file as part of its distribution"),
    ("gpl", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", "you may copy and distribute verbatim copies of the program s source code as you receive it in any medium"),
    ("gpl", "you must cause any work that you distribute or publish that in whole or in part contains or is derived from the program"),
    ("gpl", "to convey a work means any kind of propagation that enables other parties to make or receive copies"),
    ("lgpl", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("lgpl", "a program that contains no derivative of any portion of the library but is designed to work with the library"),
    ("lgpl", "this license the lesser general public license applies to some specially designated software packages"),
    ("agpl", "if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("agpl", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("gfdl", "the purpose of this license is to make a manual textbook or other functional and useful document free"),
    ("mpl", "covered software is provided under this license on an as is basis without warranty of any kind"),
    ("mpl", "modifications means any of the following any file in source code form that results from an addition to deletion from or modification of the contents of covered software"),
    ("mpl", "you must inform recipients that the source code form of the covered software is governed by the terms of this license"),
    ("epl", "the accompanying program is provided under the terms of this eclipse public license"),
    ("cpl", "the accompanying program is provided under the terms of this common public license"),
    ("cddl", "covered software is provided under this license on an as is basis without warranty of any kind either expressed or implied including without limitation warranties that the covered software is free of defects"),
    ("eupl", "this european union public licence the eupl applies to the work"),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble this license establishes"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("boost", "must be included in all copies of the software in whole or in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", "the png reference library is supplied as is"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors"),
    ("python", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("python", "this license agreement is between the python software foundation"),
    ("php", "products derived from this software may not be called php"),
    ("php", "this product includes php software freely available from"),
    ("ruby", "you may make and give away verbatim copies of the source form of the software without restriction"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "the names openssl toolkit and openssl project must not be used to endorse or promote products"),
    ("openldap", "the openldap public license version 2 8"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("w3c", "permission to copy modify and distribute this software and its documentation with or without modification for any purpose and without fee or royalty is hereby granted"),
    ("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("json", "the software shall be used for good not evil"),
    ("vim", "if you distribute a modified version of vim you are encouraged to send the maintainer a copy"),
    ("ofl", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("ofl", "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("odbl", "the database directive grants legal protection to databases"),
    ("cc-by", "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution 4 0 international public license"),
    ("cc-by-sa", "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution sharealike 4 0 international public license"),
    ("cc-by-nc", "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution noncommercial 4 0 international public license"),
    ("cc0", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders all of affirmer s copyright and related rights"),
    ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("ms-rl", "for any file you distribute that contains code from the software you must provide recipients the source code to that file along with a copy of this license"),
    ("apsl", "this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license"),
    ("ecl", "this educational community license version 2 0 is derived from the apache license"),
    ("afl", "this academic free license the license applies to any original work of authorship"),
    ("osl", "this open software license the license applies to any original work of authorship"),
    ("upl", "subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data"),
    ("bsl", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("bsl", "effective on the change date or the fourth anniversary of the first publicly available distribution"),
    ("sspl", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic", "you may not provide the software to third parties as a hosted or managed service"),
    ("polyform", "the licensor grants you a copyright license for the software to do everything you might do with the software that would otherwise infringe"),
    ("openrail", "you agree not to use the model or derivatives of the model"),
    ("llama", "you are granted a non exclusive worldwide non transferable and royalty free limited license under meta s intellectual property"),
    ("qpl", "you may copy and distribute modified versions of the software provided that patches are distributed"),
    ("nasa", "this open source agreement agreement defines the rights of use reproduction distribution modification and redistribution"),
    ("cecill", "this agreement is a free software license agreement that is the result of discussions between its authors"),
    ("mulan", "your reproduction use modification and distribution of the software shall be subject to mulan psl"),
]

#: Shorter phrases, whose places may differ a little: label, keyword, pattern, score.
TEXTS = [
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to|in to) the public domain", 0.8),
    ("proprietary", "confidential", r"(?:proprietary and confidential|confidential and proprietary)", 0.8),
    ("unknown", "licen", r"licen[cs]ed under the terms of", 0.3),
    ("unknown", "licen", r"released under (?:the|a) [^ ]+ (?:open source |free |public )?licen[cs]e", 0.3),
    ("unknown", "licen", r"(?:distributed|available) under (?:the|a) [^ ]+ licen[cs]e", 0.3),
]

#: Ways in which a family's name is used, best first: what stands before it, after it, and the score.
FORMS = [
    (r"(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?", "", 1.0),
    (r"spdx licen[cs]e identifier ", "", 1.0),
    ("", r" (?:or|and) (?:any )?later(?: version)?", 0.9),
    ("", "", 0.7),
]

#: Where any id is a license's: what stands before it, the keyword (empty: the id's), and the score.
ID_FORMS = [
    (FORMS[0][0], "", 1.0),
    (FORMS[1][0], "spdx", 1.0),
    (r"opensource org licenses? ", "opensource", 1.0),
]

#: A signature's keyword is so many of its first words: rare enough together to gate it, and in every match.
GATE = 4

#: Ids that are also names of languages, tools or firms: "released under ..." says too little of them.
NAMES = {"python", "ruby", "php", "postgresql", "openssl", "w3c", "intel", "elastic", "nasa", "json", "vim", "curl"}

#: Abbreviations that a version follows with or without a space, and a v or not: gplv3, gpl 3 0, lgplv2 1.
JOINED = {"gplv?", "lgplv?", "agplv?"}


def _beside(name: str) -> str:
    """An id that says nothing by itself, where an expression joins it to one that does, or to one with the SPDX mark."""
    clear, vague = [], []
    for _, _, n, versions, alone in IDS:
        if "(" not in n:
            (clear if alone else vague).extend(f"{n} {v}" if v else n for v in versions.split("|"))
    clear += [f"{n} {v}{x}" for n in ("gpl", "lgpl", "agpl") for v in ("2 0", "2 1", "3 0") for x in ("", " only", " or later")]
    before = [f" {x}" for x in clear] + [f"identifier {x}" for x in vague]
    return f"(?={name} )(?:{'|'.join(f'(?<={x} {op} )' for x in before for op in ('or', 'and'))}|(?={name} (?:or|and) (?:{'|'.join(clear)}) )){name}"


def _id_rules() -> list[Rule]:
    """The ids in each form and, if they say enough, alone; priorities as those of the families' forms."""
    rules = []
    for label, word, name, versions, alone in IDS:
        word = word if versions or "(" in name else f" {word} "
        full = f"{name} ?v?(?:{versions})" if versions else name
        for before, keyword, score in ID_FORMS:
            if before == FORMS[0][0] and name in NAMES:
                continue
            if versions:
                rules.append(Rule(label, keyword or word, before + full, 2, score))
            rules.append(Rule(label, keyword or word, before + name, 3, score * 0.9))
        if not alone:
            rules.append(Rule(label, word, _beside(f"{name} (?:{versions})" if versions else name), 6, 0.7))
        elif versions:
            # alone, a version has two numbers: "apache 2" may be the server
            dotted = "|".join(v for v in versions.split("|") if " " in v)
            rules.append(Rule(label, word, f"{name}(?: |v| v)(?:{dotted})", 6, 0.7))
        else:
            rules.append(Rule(label, word, name, 7, 0.63))
    return rules


def build_rules() -> list[Rule]:
    """All rules in their order: each family in each form, with a version and without, then the ids, the addresses, notices and bodies.

    Priority 0 is tried and kept first. A form with a version goes before the same without.
    """
    rules = []
    for label, keyword, name, versions in FAMILIES:
        for i, (before, after, score) in enumerate(FORMS):
            if versions:
                v = f"(?: license)?(?: version)? (?:{versions})"
                if name in JOINED:
                    v = f"(?:{v}|(?:{versions}))"
                rules.append(Rule(label, keyword, before + name + v + after, 2 * i, score))
            if before or after or label not in NAMES:  # "the json license field": a bare name says too little of these
                rules.append(Rule(label, keyword, before + name + after, 2 * i + 1, score * 0.9))
    rules += _id_rules()
    for label, keyword, name, versions in ADDRESSES:
        rules.append(Rule(label, keyword, f"{name} (?:{versions})", 2, 1.0))
        rules.append(Rule(label, keyword, name, 3, 0.9))
    rules += [Rule(label, " ".join(text.split()[:GATE]), text, 2, 0.95) for label, text in NOTICES]
    rules += [Rule(label, " ".join(text.split()[:GATE]), text, 2, 0.9) for label, text in BODIES]
    rules += [Rule(label, keyword, pattern, 9, score) for label, keyword, pattern, score in TEXTS]
    return rules


class Scanner:
    """The compiled rules and the automaton of their keywords."""

    def __init__(self, rules: list[Rule] | None = None):
        self.rules = build_rules() if rules is None else rules
        # a space on either side of a text and of a pattern keeps matches on whole words
        self.compiled = [re.compile(f"(?<= )(?:{r.pattern})(?= )") for r in self.rules]
        by: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            by.setdefault(r.keyword, []).append(i)
        self.keywords = ahocorasick.Automaton()
        for k, ids in by.items():
            self.keywords.add_word(k, ids)
        self.keywords.make_automaton()

    def candidates(self, words: str) -> list[int]:
        """The rules whose keyword occurs, in order."""
        found: set[int] = set()
        seen: set[int] = set()
        for _, ids in self.keywords.iter(words):
            if id(ids) not in seen:
                seen.add(id(ids))
                found.update(ids)
        return sorted(found)

    def scan(self, words: str) -> list[tuple[str, int, int, float]]:
        """(label, first word, word after the last, score) of what stands, in the order of the text.

        words: a space before and after each word.
        """
        raw = []
        for i in self.candidates(words):
            rule = self.rules[i]
            raw += [(rule.priority, m.start() - m.end(), i, m.start(), m.end()) for m in self.compiled[i].finditer(words)]
        if not raw:
            return []
        # what stands, by start; as none lies in another, the ends rise with the starts
        starts: list[int] = []
        stands: list[tuple[int, int, int]] = []
        for _, _, i, a, b in sorted(raw):
            k = bisect_left(starts, a)
            inside = (k and stands[k - 1][1] >= b) or (k < len(stands) and starts[k] == a and stands[k][1] >= b)
            encloses = k < len(stands) and stands[k][1] <= b
            if not inside and not encloses:
                starts.insert(k, a)
                stands.insert(k, (a, b, i))
        out, at, word = [], 0, 0
        for a, b, i in stands:
            word += words.count(" ", at, a)
            at = a
            out.append((self.rules[i].label, word - 1, word + words.count(" ", a, b), self.rules[i].score))
        return out


#: The base phrases between blanks; a look-ahead takes no blank, so that phrases may share one.
_PHRASES = re.compile(f" ({'|'.join(BASE)})(?= )")


def base_places(words: str) -> list[tuple[int, str]]:
    """(start, label) of every place of a base phrase, in one pass. No phrase can begin within another."""
    out, at, word = [], 0, 0
    for m in _PHRASES.finditer(words):
        word += words.count(" ", at, m.start())
        at = m.start()
        out.append((word, BASE[m[1]]))
    return out


def scan_text(scanner: Scanner, text: bytes | None) -> dict:
    """The findings of one whole text; null and empty texts have no words and no findings."""
    found = text.translate(ALNUM).split() if text else []
    words = f" {b' '.join(found).decode()} " if found else ""
    base = base_places(words)
    spans = scanner.scan(words)
    base_labels = {label for _, label in base}
    places = [p for p, _ in base]
    return {
        "n_words": len(found),
        "n_base": len(base),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {s[0] for s in spans})),
        # a base phrase alone counts as a plain name
        "score": max([s[3] for s in spans] + [0.63] * bool(base), default=0.0),
        "findings": [{"label": s[0], "start": s[1], "stop": s[2], "score": s[3]} for s in spans],
    }


FINDINGS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, findings array<struct<label: string, start: long, stop: long, score: double>>"
_TYPES = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("findings", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))),
]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        rows = [scan_text(scanner, t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), *(pa.array([r[n] for r in rows], t) for n, t in _TYPES)], ["key", *(n for n, _ in _TYPES)]
        )


def scan(docs: DataFrame) -> DataFrame:
    """docs (key struct, text) as key and the findings of each whole text; each row on its own, no shuffle.

    A null or empty text has no words and no labels, and score 0. Equal rows get equal findings, an
    empty table none.
    """
    schema = StructType([*docs.select("key").schema, *StructType.fromDDL(FINDINGS)])
    return docs.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(_scan, schema)


def op8_licenses(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(F.struct("doc_id").alias("key"), "text")
    return scan(docs).select("key.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
