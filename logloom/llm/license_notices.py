"""Signature rules of licenses written one by one: notices, grants, conditions, disclaimers.

Fixed values: label, keyword (a word that every text of the pattern holds), pattern over words,
confidence. The wordings are those of the public license texts; a label that isn't a license's
name says what kind of clause was found. Sentences that several licenses share have the labels
of `GENERAL`, which stand only where no license is named.
"""

GENERAL = ("gnu-notice", "mit-notice", "bsd-notice", "license-notice", "disclaimer")

NOTICES = [
    # MIT, X11 and ISC
    ("mit", "deal", "to deal in the software without restriction including without limitation the rights to use", 1.0),
    ("mit-notice", "sublicense", "(?:use )?copy modify merge publish distribute sublicense and or sell copies of the software", 1.0),
    ("mit-notice", "furnished", "permit persons to whom the software is furnished to do so", 1.0),
    ("mit", "portions", "this permission notice shall be included in all copies or substantial portions of the software", 1.0),
    ("mit-0", "attribution", "mit no attribution", 0.9),
    ("disclaimer", "noninfringement", "merchantability fitness for a particular purpose and noninfringement", 0.8),
    ("x11", "advertising", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software", 1.0),
    ("isc", "fee", "for any purpose with or without fee is hereby granted provided that the above copyright notice", 1.0),
    ("0bsd", "fee", "use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", 1.0),
    ("isc", "tortious", "whether in an action of contract negligence or other tortious action", 0.9),
    ("ncsa", "deal", "to deal with the software without restriction including without limitation the rights to use", 1.0),
    ("hpnd", "supporting", "both that copyright notice and this permission notice appear in supporting documentation", 1.0),
    ("hpnd", "suitability", "makes no representations about the suitability of this software for any purpose", 0.9),
    ("ntp", "ntp", "ntp licen[sc]e", 0.8),
    ("curl", "curl", "curl licen[sc]e", 0.8),
    # BSD
    ("bsd-notice", "retain", "redistributions of source code must retain the (?:above|accompanying) copyright notice", 1.0),
    ("bsd-notice", "reproduce", "redistributions in binary form must reproduce the (?:above|accompanying) copyright notice", 1.0),
    ("bsd-notice", "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission", 1.0),
    ("bsd-4-clause", "acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledgement", 1.0),
    ("bsd-4-clause", "california", "this product includes software developed by the university of california", 1.0),
    ("bsd", "regents", "provided by the regents and contributors as is", 0.9),
    ("bsd", "holders", "provided by the copyright holders and contributors as is", 0.9),
    ("bsd-3-clause", "bsd", "bsd 3 clause", 0.8),
    ("bsd-2-clause", "bsd", "bsd 2 clause", 0.8),
    ("bsd-2-clause-patent", "patent", "bsd 2 clause (?:plus )?patent", 0.9),
    ("bsd-3-clause-clear", "clear", "(?:the )?clear bsd(?: licen[sc]e)?", 0.8),
    # GNU family
    ("gnu-notice", "redistribute", "this (?:program|library) is free software you can redistribute it", 0.9),
    ("gnu-notice", "either", "either version [123](?: 0)? of the license or (?:at your option )?any later version", 0.9),
    ("gnu-notice", "useful", "distributed in the hope that it will be useful but without any warranty", 0.9),
    ("gpl", "received", "you should have received a copy of the gnu general public license", 1.0),
    ("gnu-notice", "franklin", "free software foundation inc 51 franklin (?:street|st) fifth floor boston", 0.9),
    ("gnu-notice", "temple", "free software foundation inc 59 temple place(?: suite 330)? boston", 0.9),
    ("gnu-notice", "mass", "free software foundation inc 675 mass ave cambridge", 0.9),
    ("gpl", "gplv2", "gplv2(?: only| or later)?", 0.9),
    ("gpl", "gplv3", "gplv3(?: only| or later)?", 0.9),
    ("gpl", "gpl", "gpl (?:v )?[123](?: 0)?(?: only| or later)?", 0.9),
    ("gpl", "preamble", "preamble the gnu general public license is a free copyleft license", 1.0),
    ("gnu-notice", "interactive", "if the program is interactive make it output a short notice", 0.8),
    ("gnu-notice", "conveying", "conveying (?:verbatim copies|modified source versions|non source forms)", 0.8),
    ("gnu-notice", "propagate", "to propagate a work means to do anything with it", 0.9),
    ("gpl-exception", "classpath", "classpath exception", 0.9),
    ("gpl-exception", "linking", "linking (?:this library|this program) statically or dynamically with other modules", 0.9),
    ("gpl-exception", "bison", "bison exception", 0.8),
    ("gpl-exception", "gcc", "gcc runtime library exception", 1.0),
    ("gpl-exception", "autoconf", "autoconf (?:configure script )?exception", 0.8),
    ("lgpl", "lgplv2", "lgplv2(?: 1)?(?: only| or later)?", 0.9),
    ("lgpl", "lgplv3", "lgplv3(?: only| or later)?", 0.9),
    ("lgpl", "lgpl", "lgpl (?:v )?[23](?: [01])?(?: only| or later)?", 0.9),
    ("lgpl", "lesser", "you should have received a copy of the gnu lesser general public license", 1.0),
    ("lgpl", "relink", "so that the user can modify the library and then relink", 0.9),
    ("agpl", "agplv3", "agplv3(?: only| or later)?", 0.9),
    ("agpl", "agpl", "agpl (?:v )?3(?: 0)?(?: only| or later)?", 0.9),
    ("agpl", "affero", "you should have received a copy of the gnu affero general public license", 1.0),
    ("agpl", "remotely", "all users interacting with it remotely through a computer network", 0.9),
    ("fdl", "invariant", "with no invariant sections(?: with)? no front cover texts and no back cover texts", 1.0),
    ("fdl", "document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 1.0),
    # Apache and Mozilla
    ("apache", "obtain", "you may obtain a copy of the license at(?: http| https)? www apache org licenses license 2 0", 1.0),
    ("disclaimer", "conditions", "without warranties or conditions of any kind either express or implied", 0.9),
    ("license-notice", "governing", "see the license for the specific language governing permissions and limitations", 0.9),
    ("license-notice", "agreed", "unless required by applicable law or agreed to in writing software", 0.9),
    ("apache", "contributor", "licensed to the apache software foundation asf under one or more contributor license agreements", 1.0),
    ("apache", "patent", "perpetual worldwide non exclusive no charge royalty free irrevocable (?:except as stated in this section )?patent license", 0.9),
    ("apache", "prominent", "you must cause any modified files to carry prominent notices stating that you changed the files", 0.9),
    ("apache-1.1", "apache", "this product includes software developed by the apache software foundation", 0.9),
    ("apache", "apache2", "apache2", 0.7),
    ("apache", "asl", "asl 2 0", 0.8),
    ("mpl", "mozilla", "this source code form is subject to the terms of the mozilla public license", 1.0),
    ("mpl", "mpl", "if a copy of the mpl was not distributed with this file you can obtain one at", 1.0),
    ("mpl", "incompatible", "this source code form is incompatible with secondary licenses", 0.9),
    ("mpl-1.1", "initial", "the initial developer of the original code is", 0.9),
    ("mpl-1.1", "contents", "the contents of this file are subject to the mozilla public license", 1.0),
    ("npl", "netscape", "(?:the )?netscape public license", 0.9),
    # Eclipse, Sun, IBM and other weak copyleft
    ("epl", "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license", 1.0),
    ("epl", "eclipse", "www eclipse org legal epl v ?(?:10|20|1 0|2 0)", 0.9),
    ("edl", "eclipse", "www eclipse org org documents edl v ?(?:10|1 0)", 0.9),
    ("cddl", "cddl", "cddl header (?:start|end)", 1.0),
    ("cddl", "cddl", "cddl (?:v )?1 [01]", 0.9),
    ("cddl", "opensolaris", "usr src opensolaris license", 0.9),
    ("ipl", "ibm", "ibm public license", 0.9),
    ("spl", "sun", "sun public license", 0.9),
    ("sissl", "sun", "sun industry standards source license", 0.9),
    ("cpal", "attribution", "common public attribution license", 0.9),
    ("ms-pl", "pl", "ms pl", 0.6),
    ("rpl", "reciprocal", "(?:rpl )?reciprocal public license", 0.9),
    ("apsl", "apple", "apple public source license", 0.9),
    ("qpl", "q", "q public license", 0.9),
    ("lppl", "conditions", "this work may be distributed and or modified under the conditions of the (?:latex project public license|lppl) (?:either version|lppl)", 0.9),
    ("lppl", "lppl", "this work has the lppl maintenance status", 1.0),
    ("eupl", "eupl", "licensed under the eupl", 1.0),
    ("cecill", "cecill", "this software is governed by the cecill(?: [bc])? license under french law", 1.0),
    ("nasa", "nasa", "nasa open source agreement", 0.9),
    ("ecl", "educational", "educational community license", 0.9),
    ("sleepycat", "sleepycat", "sleepycat license", 0.8),
    ("watcom", "watcom", "sybase open watcom public license", 0.9),
    # permissive with a name of its own
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented", 1.0),
    ("zlib", "altered", "altered source versions must be plainly marked as such", 1.0),
    ("zlib", "arising", "in no event will the authors be held liable for any damages arising from the use of this software", 0.9),
    ("zlib", "freely", "to alter it and redistribute it freely subject to the following restrictions", 0.9),
    ("boost", "boost", "distributed under the boost software license", 1.0),
    ("boost", "executable", "machine executable object code generated by a source language processor", 0.9),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 1.0),
    ("unlicense", "relinquishment", "an overt act of relinquishment in perpetuity", 0.9),
    ("unlicense", "unlicense", "(?:for more information please refer to http )?unlicense org", 0.9),
    ("wtfpl", "wtfpl", "(?:http )?www wtfpl net", 0.9),
    ("wtfpl", "fuck", "you just do what the fuck you want to", 1.0),
    ("beerware", "beer", "you can buy me a beer in return", 1.0),
    ("beerware", "beerware", "(?:the )?beerware license", 0.9),
    ("jslint", "evil", "the software shall be used for good not evil", 1.0),
    ("openssl", "openssl", "developed by the openssl project for use in the openssl toolkit", 1.0),
    ("ssleay", "eric", "this product includes cryptographic software written by eric young", 1.0),
    ("python", "python", "python software foundation license agreement", 0.9),
    ("python", "psf", "psf is making python available to licensee on an as is basis", 1.0),
    ("python", "cnri", "cnri (?:open source )?license agreement", 0.8),
    ("php", "php", "this product includes php software freely available from", 1.0),
    ("php", "php", "subject to version [23] 0[01]? of the php license", 1.0),
    ("ruby", "ruby", "you can redistribute it and or modify it under (?:either )?the (?:same )?terms (?:of|as) (?:ruby|the ruby license) (?:ruby|itself)", 0.8),
    ("artistic", "perl", "(?:you can redistribute it and or modify it )?under the same terms as perl(?: itself)?", 0.9),
    ("artistic", "artistic", "the artistic license 2 0", 0.9),
    ("postgresql", "documentation", "permission to use copy modify and distribute this software and its documentation for any purpose without fee", 0.9),
    ("postgresql", "california", "in no event shall the university of california be liable to any party", 0.9),
    ("vim", "uganda", "(?:help|donate to) poor children in uganda", 0.8),
    ("vim", "charityware", "vim is charityware", 1.0),
    ("icu", "unicode", "unicode (?:license agreement|inc license agreement) data files and software", 1.0),
    ("unicode", "unicode", "unicode license v3", 0.9),
    ("w3c", "w3c", "w3c software and document (?:notice and )?license", 0.9),
    ("ofl", "reserved", "with reserved font name", 0.9),
    ("sil-ofl", "sil", "this font software is licensed under the sil open font license", 1.0),
    ("bitstream-vera", "bitstream", "bitstream vera (?:is a trademark|fonts copyright)", 0.9),
    ("freetype", "freetype", "(?:the )?freetype (?:project )?license", 0.9),
    ("ijg", "jpeg", "this software is based in part on the work of the independent jpeg group", 1.0),
    ("tcl", "tcl", "tcl tk license", 0.8),
    ("json", "json", "json license", 0.6),
    ("blueoak", "oak", "blue oak model license", 1.0),
    ("mulan", "mulan", "mulan (?:psl|permissive software license|publ|public license)", 0.9),
    # Creative Commons, data and models
    ("cc-by", "deed", "attribution [1234] 0 international deed", 0.8),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1234] [05]", 1.0),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1234] [05]", 1.0),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1234] [05]", 1.0),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1234] [05]", 1.0),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1234] [05]", 1.0),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1234] [05]", 1.0),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero 1 0", 1.0),
    ("public-domain", "creativecommons", "creativecommons org publicdomain mark 1 0", 1.0),
    ("cc0", "waived", "has waived all copyright and related or neighboring rights", 1.0),
    ("cc-by", "credit", "you must give appropriate credit provide a link to the license and indicate if changes were made", 0.9),
    ("cc-by-sa", "remix", "if you remix transform or build upon the material you must distribute your contributions under the same license", 1.0),
    ("cc-by-nd", "remix", "if you remix transform or build upon the material you may not distribute the modified material", 1.0),
    ("odbl", "opendatacommons", "opendatacommons org licenses odbl(?: 1 0)?", 1.0),
    ("odc-by", "opendatacommons", "opendatacommons org licenses by(?: 1 0)?", 1.0),
    ("pddl", "opendatacommons", "opendatacommons org licenses pddl(?: 1 0)?", 1.0),
    ("odbl", "openstreetmap", "openstreetmap contributors(?: odbl)?", 0.7),
    ("cdla", "cdla", "cdla (?:permissive|sharing)(?: [12] 0)?", 0.9),
    ("cdla", "community", "community data license agreement", 0.9),
    ("ogl", "government", "open government licen[sc]e(?: v ?[123](?: 0)?)?", 0.9),
    ("etalab", "etalab", "(?:licence ouverte )?etalab(?: 2 0)?", 0.7),
    ("llama", "llama", "llama [234](?: [0-9])? community license", 1.0),
    ("gemma", "gemma", "gemma terms of use", 0.9),
    ("openrail", "openrail", "bigscience openrail m", 1.0),
    # source available and proprietary
    ("sspl", "mongodb", "mongodb inc server side public license", 0.9),
    ("busl", "change", "change date (?:four years|[0-9]+ [0-9]+ [0-9]+) (?:from|change) (?:the date|license)", 0.8),
    ("busl", "mariadb", "business source license is (?:a trademark|copyright) (?:of )?mariadb", 0.9),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict|perimeter|internal use|free trial)(?: license)?", 1.0),
    ("confluent", "confluent", "confluent community license", 1.0),
    ("redis", "redis", "redis source available license", 1.0),
    ("commons-clause", "grant", "the license does not grant to you the right to sell the software", 1.0),
    ("proprietary", "proprietary", "(?:confidential and proprietary|proprietary and confidential)", 0.8),
    ("proprietary", "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)(?: of this file)? (?:via any medium )?is strictly prohibited", 0.9),
    ("proprietary", "eula", "(?:this )?eula is a legal agreement between you and", 0.9),
    ("proprietary", "reverse", "you may not reverse engineer decompile or disassemble", 0.8),
    ("proprietary", "secrets", "contains (?:confidential information and )?trade secrets of", 0.7),
    ("proprietary", "personal", "for (?:your )?personal non ?commercial use only", 0.7),
    ("proprietary", "evaluation", "for (?:internal )?evaluation purposes only", 0.7),
    ("proprietary", "reproduced", "no part of this (?:publication|work|book|document) may be reproduced", 0.8),
    # clauses of many licenses
    ("disclaimer", "merchantability", "(?:implied )?warranties of merchantability", 0.5),
    ("disclaimer", "liable", "in no event shall the (?:authors or copyright holders|contributors or copyright holders|copyright (?:holders|holder|owner)(?: or contributors)?|regents or contributors|author|contributors) be liable", 0.5),
    ("disclaimer", "warranty", "the software is provided as is without warranty of any kind", 0.6),
    ("disclaimer", "negligence", "whether in contract strict liability or tort including negligence or otherwise", 0.5),
    ("disclaimer", "procurement", "procurement of substitute goods or services", 0.5),
]
