"""Passages of common licences as runs of lower-case words, with the phrases a passage must hold.

Fixed values: the wording is that of the published licence texts and of the notices they ask for.
"""

from __future__ import annotations

#: Fixed phrases and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Label, passage, mandatory key phrases (each part of the passage). Fixed values.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted"]),
    ("mit", "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", ["deal in the software without restriction"]),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ["permission notice shall be included"]),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software", ["authors or copyright holders be liable"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ["in compliance with the license"]),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", ["without warranties or conditions of any kind"]),
    ("apache", "see the license for the specific language governing permissions and limitations under the license", ["specific language governing permissions"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", ["gnu general public license"]),
    ("gpl", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ["gnu general public license"]),
    ("gpl", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details", ["gnu general public license"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("lgpl", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license for more details", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license", ["gnu affero general public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ["attribution noncommercial"]),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ["attribution sharealike"]),
    ("cc-by", "creative commons attribution 4 0 international license", ["commons attribution 4 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms"]),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ["redistributions of source code"]),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ["redistributions in binary form"]),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ["endorse or promote products"]),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed", ["provided by the copyright holders and contributors"]),
    ("bsd", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption", ["procurement of substitute goods"]),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at", ["copy of the mpl"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify"]),
    ("isc", "provided that the above copyright notice and this permission notice appear in all copies", ["permission notice appear in all copies"]),
    ("isc", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits", ["any damages whatsoever resulting"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", ["authors be held liable"]),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", ["must not be misrepresented"]),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", ["any person or organization"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", ["source code form or as a compiled binary"]),
]
