"""Licence families, their names, and paragraphs of their public notices."""

#: family: (identifier, names used in short notices)
NAMES = {
    "AGPL-3.0": ("AGPL-3.0-only", ["GNU Affero General Public License, version 3", "GNU AGPL v3"]),
    "Apache-2.0": ("Apache-2.0", ["Apache License, Version 2.0", "Apache 2.0 License"]),
    "BSD-2-Clause": ("BSD-2-Clause", ["BSD 2-Clause License", "Simplified BSD License"]),
    "BSD-3-Clause": ("BSD-3-Clause", ["BSD 3-Clause License", "New BSD License"]),
    "CC-BY-4.0": ("CC-BY-4.0", ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"]),
    "CC-BY-NC-4.0": ("CC-BY-NC-4.0", ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"]),
    "CC-BY-SA-4.0": ("CC-BY-SA-4.0", ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"]),
    "CC0-1.0": ("CC0-1.0", ["CC0 1.0 Universal", "Creative Commons Zero public domain dedication"]),
    "GPL-2.0": ("GPL-2.0-only", ["GNU General Public License, version 2", "GNU GPL v2"]),
    "GPL-3.0": ("GPL-3.0-only", ["GNU General Public License, version 3", "GNU GPL v3"]),
    "ISC": ("ISC", ["ISC License"]),
    "LGPL-3.0": ("LGPL-3.0-only", ["GNU Lesser General Public License, version 3", "GNU LGPL v3"]),
    "MIT": ("MIT", ["MIT License"]),
    "MPL-2.0": ("MPL-2.0", ["Mozilla Public License, v. 2.0", "Mozilla Public License, version 2.0"]),
    "Unlicense": ("Unlicense", ["Unlicense"]),
}

#: Short notices, to be filled with a name (or the identifier, in the last).
NOTICES = [
    "Licensed under {0}.",
    "Licensed under the {0}.",
    "Released under the {0}.",
    "This work is licensed under the {0}.",
    "Distributed under the terms of the {0}.",
    "This file is made available under the {0}.",
    "SPDX-License-Identifier: {1}",
]

#: Paragraphs of the families' own texts and standard headers.
PARAGRAPHS = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following two conditions are met: redistributions of source code must retain the copyright notice, this list of conditions and the disclaimer.",
    ],
    "BSD-3-Clause": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/.",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/.",
    ],
    "CC-BY-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. See the CC0 1.0 Universal Public Domain Dedication.",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-3.0": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}

#: Sentences that speak of licences without granting one.
NOT_A_LICENCE = [
    "All rights reserved.",
    "You need a valid driver's license to rent a car in this country.",
    "The license fee is due at the beginning of each year.",
    "The committee discussed the license of the restaurant and its renewal.",
    "Software licenses are a common topic in this course.",
    "Permission to enter the building is given by the front desk.",
    "The terms of the agreement were published by the foundation last year.",
    "A copy of the report was distributed to all members without restriction.",
    "This work was published in the first version of the collection.",
    "Her poetic license with the facts annoyed the editor.",
]
