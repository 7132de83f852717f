"""Signature rules of the licence scan, in order of precedence within a level.

One rule a line: label, level, keyword, pattern.  Patterns are matched against
lower-cased words parted by single blanks (punctuation is gone: "GPL-3.0" is
"gpl 3 0"); they stand for whole words and span a bounded number of words.  A
pattern is tried only on texts that hold its keyword as a word.  Levels: 4 a
notice, tag or sentence of the licence itself, 3 a name with version or an
address, 2 a name, 1 a mention.
"""

RULES = r"""
mit 4 permission permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit 4 license spdx license identifier mit
mit 4 license (licensed|released|distributed|available|published) under (the )?(terms of the )?mit license
mit 3 licenses opensource org licenses mit
mit 3 license mit license mit
mit 2 license mit license
mit 2 licence mit licence
mit 2 license (expat|x11) license
mit 2 license mit style license
mit-0 4 license spdx license identifier mit 0
mit-0 3 license mit no attribution license
apache-2.0 4 license licensed under the apache license version 2 0
apache-2.0 4 license spdx license identifier apache 2 0
apache-2.0 4 license you may not use this file except in compliance with the license
apache-2.0 4 license you may obtain a copy of the license at http www apache org licenses license 2 0
apache-2.0 3 license apache (software )?license (version |v)?2( 0)?
apache-2.0 3 license apache license v2( 0)?
apache-2.0 3 licenses apache org licenses license 2 0
apache-2.0 3 licence apache (software )?licence (version )?2( 0)?
apache-1.1 4 license spdx license identifier apache 1 1
apache-1.1 3 license apache (software )?license (version )?1 1
apache-1.0 3 license apache (software )?license (version )?1 0
apache 4 license licensed to the apache software foundation asf under one or more contributor license agreements
apache 4 license (licensed|released|distributed) under (the )?apache license
apache 2 license apache license
apache 2 license apache software license
gpl-2.0 4 license spdx license identifier gpl 2 0( only)?
gpl-2.0 4 license under the terms of the gnu general public license (as published by the free software foundation )?version 2
gpl-2.0 3 license gnu general public license (version |v)2( 0)?
gpl-2.0 3 license gnu general public license v2( 0)?
gpl-2.0 3 gplv2 gplv2( only)?
gpl-2.0 3 gpl gpl (version )?2( 0)?( only)?
gpl-2.0 3 licenses gnu org licenses (old licenses )?gpl 2 0
gpl-2.0-or-later 4 license either version 2 of the license or at your option any later version
gpl-2.0-or-later 4 license spdx license identifier gpl 2 0 or later
gpl-2.0-or-later 3 gplv2 gplv2 or later
gpl-2.0-or-later 3 gpl gpl (version )?2( 0)? or (any )?later
gpl-3.0 4 license spdx license identifier gpl 3 0( only)?
gpl-3.0 4 license under the terms of the gnu general public license (as published by the free software foundation )?version 3
gpl-3.0 3 license gnu general public license (version |v)3( 0)?
gpl-3.0 3 license gnu general public license v3( 0)?
gpl-3.0 3 gplv3 gplv3( only)?
gpl-3.0 3 gpl gpl (version )?3( 0)?( only)?
gpl-3.0 3 licenses gnu org licenses gpl 3 0
gpl-3.0-or-later 4 license either version 3 of the license or at your option any later version
gpl-3.0-or-later 4 license spdx license identifier gpl 3 0 or later
gpl-3.0-or-later 3 gplv3 gplv3 or later
gpl-3.0-or-later 3 gpl gpl (version )?3( 0)? or (any )?later
gpl-1.0 4 license spdx license identifier gpl 1 0
gpl-1.0 3 license gnu general public license (version )?1( 0)?
gpl 4 license you should have received a copy of the gnu general public license along with
gpl 4 license (licensed|released|distributed) under (the )?(terms of the )?gnu general public license
gpl 3 licenses gnu org licenses gpl
gpl 2 license gnu general public license
gpl 2 licence gnu general public licence
gpl 2 gpl gnu gpl
gpl 2 gpl the gpl
gpl 2 gpl gpl licen[cs]ed?
lgpl-2.0 4 license spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.0 3 license gnu library general public license( version 2( 0)?)?
lgpl-2.1 4 license spdx license identifier lgpl 2 1( only| or later)?
lgpl-2.1 4 license gnu lesser general public license as published by the free software foundation either version 2 1
lgpl-2.1 3 license gnu lesser general public license (version |v)2 1
lgpl-2.1 3 lgpl lgpl (version )?2 1
lgpl-2.1 3 licenses gnu org licenses (old licenses )?lgpl 2 1
lgpl-3.0 4 license spdx license identifier lgpl 3 0( only| or later)?
lgpl-3.0 4 license gnu lesser general public license as published by the free software foundation either version 3
lgpl-3.0 3 license gnu lesser general public license (version |v)3( 0)?
lgpl-3.0 3 lgplv3 lgplv3
lgpl-3.0 3 lgpl lgpl (version )?3( 0)?
lgpl-3.0 3 licenses gnu org licenses lgpl 3 0
lgpl 4 license you should have received a copy of the gnu lesser general public license
lgpl 3 licenses gnu org licenses lgpl
lgpl 2 license (gnu )?lesser general public license
lgpl 2 lgpl (gnu )?lgpl
agpl-1.0 3 license affero general public license (version )?1( 0)?
agpl-3.0 4 license spdx license identifier agpl 3 0( only| or later)?
agpl-3.0 4 license gnu affero general public license as published by the free software foundation either version 3
agpl-3.0 3 license (gnu )?affero general public license (version |v)?3( 0)?
agpl-3.0 3 agplv3 agplv3
agpl-3.0 3 agpl agpl (version )?3( 0)?
agpl-3.0 3 licenses gnu org licenses agpl 3 0
agpl 2 license (gnu )?affero general public license
agpl 2 agpl (gnu )?agpl
gfdl-1.1 4 license spdx license identifier gfdl 1 1( only| or later)?
gfdl-1.2 4 license spdx license identifier gfdl 1 2( only| or later)?
gfdl-1.3 4 license spdx license identifier gfdl 1 3( only| or later)?
gfdl-1.2 3 license gnu free documentation license version 1 2
gfdl-1.3 3 license gnu free documentation license version 1 3
gfdl 3 licenses gnu org licenses fdl
gfdl 2 license (gnu )?free documentation license
bsd-2-clause 4 license spdx license identifier bsd 2 clause
bsd-2-clause 3 license (2|two) clause bsd license
bsd-2-clause 3 license bsd 2 clause (simplified )?license
bsd-2-clause 2 license (simplified bsd|freebsd) license
bsd-3-clause 4 license spdx license identifier bsd 3 clause
bsd-3-clause 4 endorse neither the name of (the )?([^ ]+ ){0,6}nor the names of its contributors may be used to endorse or promote products derived from this software
bsd-3-clause 3 license (3|three) clause bsd license
bsd-3-clause 3 license bsd 3 clause ((new|revised) ){0,2}license
bsd-3-clause 2 license (new|modified|revised) bsd license
bsd-4-clause 4 license spdx license identifier bsd 4 clause
bsd-4-clause 3 license (4|four) clause bsd license
bsd-4-clause 2 license (original|old) bsd license
bsd-0-clause 4 license spdx license identifier 0bsd
bsd-0-clause 3 license (zero|0) clause bsd license
bsd 4 copyright redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd 4 copyright redistributions in binary form must reproduce the above copyright notice
bsd 4 license (licensed|released|distributed) under (the )?bsd( style)? license
bsd 2 license bsd( style)? license
bsd 2 licence bsd( style)? licence
isc 4 copyright provided that the above copyright notice and this permission notice appear in all copies
isc 4 license spdx license identifier isc
isc 2 license isc license
mpl-1.0 4 license spdx license identifier mpl 1 0
mpl-1.1 4 license spdx license identifier mpl 1 1
mpl-1.1 3 license mozilla public license (version |v)?1 1
mpl-2.0 4 license this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 4 license spdx license identifier mpl 2 0
mpl-2.0 3 license mozilla public license (version |v )?2( 0)?
mpl-2.0 3 license mpl license 2 0
mpl 2 license mozilla public license
epl-1.0 4 license spdx license identifier epl 1 0
epl-1.0 3 license eclipse public license (version |v )?1( 0)?
epl-2.0 4 license spdx license identifier epl 2 0
epl-2.0 3 license eclipse public license (version |v )?2( 0)?
epl 2 license eclipse public license
edl-1.0 2 license eclipse distribution license
cddl-1.0 4 license spdx license identifier cddl 1 0
cddl-1.0 3 license common development and distribution license (version )?1 0
cddl-1.1 4 license spdx license identifier cddl 1 1
cddl-1.1 3 license common development and distribution license (version )?1 1
cddl 2 license common development and distribution license
cpl-1.0 2 license common public license
ipl-1.0 2 license ibm public license
cpal-1.0 2 license common public attribution license
eupl-1.1 4 eupl licensed under the eupl version 1 1
eupl-1.2 4 eupl licensed under the eupl version 1 2
eupl-1.2 4 license spdx license identifier eupl 1 2
eupl 2 licence european union public licence
eupl 2 license european union public license
artistic-1.0 4 license spdx license identifier artistic 1 0
artistic-1.0 3 license artistic license (version )?1( 0)?
artistic-2.0 4 license spdx license identifier artistic 2 0
artistic-2.0 3 license artistic license (version )?2( 0)?
artistic 2 license artistic license
boost-1.0 4 license spdx license identifier bsl 1 0
boost-1.0 4 license distributed under the boost software license version 1 0
boost-1.0 3 license boost software license (version )?1 0
boost-1.0 2 license boost software license
bsl-1.1 4 license spdx license identifier busl 1 1
bsl-1.1 2 license business source license
zlib 4 license spdx license identifier zlib
zlib 2 license zlib license
zlib 2 license zlib libpng license
libpng 2 license libpng license
unlicense 4 domain this is free and unencumbered software released into the public domain
unlicense 4 license spdx license identifier unlicense
unlicense 3 unlicense unlicense org
unlicense 2 unlicense the unlicense
wtfpl 4 license spdx license identifier wtfpl
wtfpl 2 license do what the [^ ]+ you want to public license
beerware 2 license (beerware|beer ware) license
python-2.0 4 license spdx license identifier (python|psf) 2 0
python-2.0 2 license (python software foundation|psf) license
python-2.0 2 license python license
php-3.01 4 license spdx license identifier php 3 01
php-3.01 3 license php license (version )?3 01
php 2 license php license
ruby 2 license ruby license
perl 4 license same terms as perl itself under the artistic license
ms-pl 4 license spdx license identifier ms pl
ms-pl 2 license microsoft public license
ms-rl 4 license spdx license identifier ms rl
ms-rl 2 license microsoft reciprocal license
openssl 2 license openssl license
ssleay 2 license ssleay license
curl 4 license spdx license identifier curl
curl 2 license curl license
postgresql 4 license spdx license identifier postgresql
postgresql 2 license postgresql license
sspl-1.0 4 license spdx license identifier sspl 1 0
sspl-1.0 2 license server side public license
elastic-2.0 4 license spdx license identifier elastic 2 0
elastic-2.0 2 license elastic license
odbl-1.0 4 license spdx license identifier odbl 1 0
odbl-1.0 2 license open (data commons )?open database license
odbl-1.0 2 license open database license
odc-by-1.0 4 license spdx license identifier odc by 1 0
odc-by-1.0 2 license open data commons attribution license
pddl-1.0 2 license public domain dedication and license
ofl-1.1 4 license licensed under the sil open font license version 1 1
ofl-1.1 4 license spdx license identifier ofl 1 1
ofl-1.1 3 license open font license (version )?1 1
ofl 2 license (sil )?open font license
ncsa 4 license spdx license identifier ncsa
ncsa 2 license university of illinois ncsa open source license
w3c 2 license w3c software (notice and )?license
vim 2 license vim license
icu 2 license icu license
unicode 2 license unicode (data files and software )?license
afl-3.0 3 license academic free license (version )?3 0
afl 2 license academic free license
osl-3.0 3 license open software license (version )?3 0
osl 2 license open software license
upl-1.0 2 license universal permissive license
mulan-2.0 2 license mulan (permissive software|psl) license
blueoak-1.0 2 license blue oak model license
polyform 2 license polyform [^ ]+ license
openrail 4 license creativeml open rail m license
openrail 2 license (bigscience )?(openrail|open rail)( m)? license
llama 2 license llama ([^ ]+ )?community license
apsl 2 license apple public source license
qpl 2 license q public license
sleepycat 2 license sleepycat license
rpl 2 license reciprocal public license
cecill-2.1 2 license cecill ([^ ]+ )?license
etalab-2.0 2 licence licence ouverte
ogl-3.0 3 licence open government licence v3 0
ogl 2 licence open government licence
cc0-1.0 4 license spdx license identifier cc0 1 0
cc0-1.0 3 creativecommons creativecommons org publicdomain zero 1 0
cc0-1.0 3 commons creative commons (cc0|zero)
cc0-1.0 2 license cc0 license
cc-by-4.0 4 license spdx license identifier cc by 4 0
cc-by-4.0 4 license licensed under a creative commons attribution 4 0 international license
cc-by-4.0 3 commons creative commons attribution 4 0
cc-by-4.0 3 cc cc by 4 0
cc-by-3.0 4 license spdx license identifier cc by 3 0
cc-by-3.0 3 commons creative commons attribution 3 0
cc-by-3.0 3 cc cc by 3 0
cc-by-2.0 3 cc cc by 2 0
cc-by-sa-4.0 4 license spdx license identifier cc by sa 4 0
cc-by-sa-4.0 3 commons creative commons attribution (sharealike|share alike) 4 0
cc-by-sa-4.0 3 cc cc by sa 4 0
cc-by-sa-3.0 3 commons creative commons attribution (sharealike|share alike) 3 0
cc-by-sa-3.0 3 cc cc by sa 3 0
cc-by-sa 2 commons creative commons attribution (sharealike|share alike)
cc-by-sa 2 cc cc by sa
cc-by-nc-4.0 3 cc cc by nc 4 0
cc-by-nc 2 commons creative commons attribution (noncommercial|non commercial)
cc-by-nc 2 cc cc by nc
cc-by-nd 2 commons creative commons attribution (noderivs|noderivatives|no derivs|no derivatives)
cc-by-nd 2 cc cc by nd
cc-by-nc-sa 2 commons creative commons attribution (noncommercial|non commercial) (sharealike|share alike)
cc-by-nc-sa 2 cc cc by nc sa
cc-by-nc-nd 2 commons creative commons attribution (noncommercial|non commercial) (noderivs|noderivatives|no derivs|no derivatives)
cc-by-nc-nd 2 cc cc by nc nd
cc-by 2 commons creative commons attribution
cc-by 2 cc cc by
creative-commons 2 commons creative commons licen[cs]ed?
creative-commons 1 commons creative commons
public-domain 4 domain (dedicated|released|placed) (in)?to the public domain
public-domain 2 domain public domain dedication
public-domain 1 domain (in )?the public domain
all-rights-reserved 2 copyright copyright (c )?([^ ]+ ){1,6}all rights reserved
copyright 1 copyright copyright (c )?(19|20)[0-9][0-9]
proprietary 2 license (proprietary|commercial) license( agreement)?
proprietary 2 license end user license agreement
open-source 1 license open source license
dual-license 1 license dual license
unknown-license 1 license (licensed|released|distributed) under (the )?([^ ]+ ){0,5}license
unknown-license 1 licence (licensed|released|distributed) under (the )?([^ ]+ ){0,5}licence
unknown-license 1 license see the license
"""
