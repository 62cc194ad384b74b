"""Licence notices in normal form (words in lower case, separators as one space).

Each entry: labels, notice, mandatory key phrases (one must occur in the file).
The first label is the family, a second one the version. Texts are as the licences
and their publishers give them.
"""

# Short notices.
SHORT_NOTICES = [
    (("agpl",), "gnu affero general public license", ["gnu affero general public license"]),
    (("all-rights-reserved",), "all rights reserved", ["all rights reserved"]),
    (("apache",), "apache license", ["apache license"]),
    (("apache", "apache-2.0"), "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    (("cc-by",), "cc by", ["cc by"]),
    (("cc-by",), "creative commons attribution 4 0 international license", ["creative commons attribution"]),
    (("cc-by", "cc-by-4.0"), "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    (("cc-by-nc",), "licensed under cc by nc 4 0", ["cc by nc"]),
    (("cc-by-nc",), "creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial"]),
    (("cc-by-nd",), "licensed under cc by nd 4 0", ["cc by nd"]),
    (("cc-by-nd",), "creative commons attribution noderivatives 4 0 international license", ["creative commons attribution noderivatives"]),
    (("cc-by-sa",), "licensed under cc by sa 4 0", ["cc by sa"]),
    (("cc-by-sa",), "creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    (("cc0",), "cc0 1 0 universal public domain dedication", ["cc0 1 0 universal", "cc0 public domain dedication"]),
    (("epl",), "eclipse public license", ["eclipse public license"]),
    (("epl", "epl-2.0"), "eclipse public license v 2 0", ["eclipse public license v 2 0", "eclipse public license 2 0"]),
    (("gpl",), "gnu general public license", ["gnu general public license"]),
    (("gpl", "gpl-3.0"), "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    (("gpl", "gpl-2.0"), "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    (("lgpl",), "gnu lesser general public license", ["gnu lesser general public license"]),
    (("mit",), "mit license", ["mit license"]),
    (("mit",), "released under the mit license", ["mit license"]),
    (("ofl",), "sil open font license", ["sil open font license", "open font license version 1 1"]),
]

# The notices that files carry, and licences short enough to stand in a file.
WHOLE_NOTICES = [
    (
        ("agpl", "agpl-3.0"),
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
        ["gnu affero general public license as published by the free software foundation either version 3"],
    ),
    (
        ("apache", "apache-2.0"),
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed "
        "to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        ["apache license version 2 0", "apache software license version 2 0"],
    ),
    (
        ("apache",),
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        ["apache license", "apache software license"],
    ),
    (
        ("bsd", "bsd-2-clause"),
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and "
        "the following disclaimer in the documentation and or other materials provided with the distribution",
        ["redistributions in binary form must reproduce the above copyright notice"],
    ),
    (
        ("bsd", "bsd-3-clause"),
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission",
        ["to endorse or promote products derived from this software"],
    ),
    (
        ("bsd",),
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    (
        ("cc0",),
        "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her "
        "rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law",
        ["dedicated the work to the public domain"],
    ),
    (
        ("epl", "epl-2.0"),
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is "
        "available at https www eclipse org legal epl 2 0",
        ["eclipse public license 2 0", "eclipse public license v 2 0"],
    ),
    (
        ("gpl", "gpl-2.0"),
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 2 of the license or at your option any later version",
        ["free software foundation either version 2"],
    ),
    (
        ("gpl", "gpl-3.0"),
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version",
        ["gnu general public license as published by the free software foundation either version 3"],
    ),
    (
        ("gpl",),
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation",
        ["gnu general public license"],
    ),
    (
        ("isc",),
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies",
        ["permission to use copy modify and or distribute this software", "permission to use copy modify and distribute this software"],
    ),
    (
        ("lgpl", "lgpl-2.1"),
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license "
        "as published by the free software foundation either version 2 1 of the license or at your option any later version",
        ["free software foundation either version 2 1"],
    ),
    (
        ("lgpl", "lgpl-3.0"),
        "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license "
        "as published by the free software foundation either version 3 of the license or at your option any later version",
        ["gnu lesser general public license as published by the free software foundation either version 3"],
    ),
    (
        ("mit",),
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction",
        ["permission is hereby granted free of charge"],
    ),
    (
        ("mit",),
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
        "to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software the software is provided as is without warranty of any kind express or implied including but not limited "
        "to the warranties of merchantability fitness for a particular purpose and noninfringement",
        ["permission is hereby granted free of charge"],
    ),
    (
        ("mpl", "mpl-2.0"),
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
        "this file you can obtain one at http mozilla org mpl 2 0",
        ["mozilla public license v 2 0"],
    ),
    (
        ("mpl",),
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license"],
    ),
    (
        ("ofl", "ofl-1.1"),
        "this font software is licensed under the sil open font license version 1 1 this license is available with a faq at "
        "https openfontlicense org",
        ["sil open font license version 1 1"],
    ),
    (
        ("unlicense",),
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or "
        "distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by "
        "any means",
        ["free and unencumbered software released into the public domain"],
    ),
    (
        ("zlib",),
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
        "damages arising from the use of this software permission is granted to anyone to use this software for any purpose including "
        "commercial applications and to alter it and redistribute it freely subject to the following restrictions",
        ["alter it and redistribute it freely"],
    ),
]

TEMPLATES = SHORT_NOTICES + WHOLE_NOTICES

# Function words that index nothing.
FUNCTION_WORDS = """
0 1 2 3 4 a above all an and any anyone appear are as at available be but by can code copies copy deal distributed either except file
for form forms free freely from her his if in including is it its kind law limited list made may means met must names no nor not of
on one option or other person persons portions program public purpose see sell shall so software source subject that the this to under
use used v version was which who whom will with without work worldwide you your
""".split()
