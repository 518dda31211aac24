"""Wordings of licence notices and licence texts, as published.

NOTICES stand on one line; GRANTS are paragraphs of licence texts and file headers.
"""

NOTICES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the MIT License."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "Released under the GNU General Public License."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl", "Released under the GNU Lesser General Public License."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("bsd", "Released under the BSD License."),
    ("bsd", "Use of this source code is governed by a BSD-style license"),
    ("mpl", "Licensed under the Mozilla Public License, version 2.0."),
    ("isc", "Released under the ISC License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
]

GRANTS = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
             "(at your option) any later version"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
            "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means"),
]
