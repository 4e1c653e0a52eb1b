"""The small labelled table that the model of personal data is trained on.

A row is a line of text with its spans marked ``<kind|text>``.  ``#`` stands for a digit, ``~`` for a word of small
letters, ``^`` for a capitalised one; every row is filled in several ways by a fixed rule.
"""

from __future__ import annotations

import random
import re

ROWS = """
write to <email|~.##@~#.~.com> today
^ ~ <email|~@~.org>, ~ ~ ~
Mail: <email|~.~@~-~.co.uk>.
e-mail <email|~_##@~.~.net>; ~
contact (<email|^.^@~.de>) ~ ~
~ ~ ~ <email|~#@~#.~.com> ~ ~ ~
"<email|~+~@~.io>"
reach me at <email|~ (at) ~.com> ~
^ ~, <email|~ [at] ~.org>
~ <email|~.~ (at) ~ (dot) com> ~ ~
<email|~ [at] ~ [dot] net> ~ ~ ~
~ ~ <email|~{at}~{dot}~{dot}com>, ~
mail <email|~##(at)~.com> ~
mail <email|~ at ~ dot com> ~ ~
contact: <email|~.~ at ~-~ dot org>
~ ~ <email|~## at ~## dot ~ dot net>. ^ ~
<email|~@~.com> <email|~@~.net>
from server <ip|192.168.#.##> ~
~ ~ <ip|1#.##.##.#> ~ ~
host <ip|10.#.##.1##>:8080
IP <ip|2#.1##.##.##>, ~ ~
~ (<ip|8#.1##.1##.#>) ~
ping <ip|1##[.]1##[.]#[.]#>
blocked <ip|4#[.]##[.]1##[.]##> ~ ~
~ ~ <ip|172.1#[.]##.#> ~
<ip|1##.1##.##.##> - - [##/^/####:##:##:##
~ ~ ~ <card|################> ~ ~ ~
card <card|#### #### #### ####> ~
~ <card|####-####-####-####>, ~ ~
pay with <card|################>.
^ ~ <card|################> <card|################> ~ ~
~ <card|#### #### #### ####> <card|#### #### #### ####> ~
visa <card|################> or <card|################>
~ <card|#### ###### #####> ~
amex <card|3###-######-#####>
card number: <card|3##############> ~
~ ~ <card|###############> ~ ~
~ <card|####.####.####.####> ~
card no <card|#############> ~
### <card|################>$$$ ~
no. <card|#### #### #### ### ###>; ~
~ ~ <phone|+1 (###) 555-####> ~ ~
call <phone|+## ### ### ###> ~
tel. <phone|+## (#) ## #### ####>, ~
Phone <phone|+#-###-###-####>.
~ <phone|+##.###.###.###> ~
~ ~ <phone|+############> ~ ~
call <phone|(###) ###-####> ~ ~
Phone: <phone|(###) 555-####>, ~ ~
~ ~ <phone|(###) 555-####> ~ ~
~ <phone|###-###-####> ~ ~
tel <phone|###-555-####>.
fax <phone|###.###.####> ~
Tel. <phone|0## / #### ####> ~
mobile <phone|0### #######> ~
<phone|1-800-###-####> ~ ~
~ ~ <phone|1 (###) ###-####> ~
phone <phone|00## ### ### ####>
call us: <phone|0# ## ## ## ##> ~
mobil <phone|01## ########>, ~
fax: <phone|+1 ### ### ####>, phone: <phone|+1 ### ### ####>
~ <phone|+1 (###) ###-####> <ip|1##.#.##.###> ~
~ ~ <phone|+1 (###) ###-####> <ip|1##.1##.2##.##> ~ ~
call <phone|+1 (###) 555-####> <ip|1##.1##.##.2##> ~
~ <ip|1##.1##.##.#> <phone|+1 (###) ###-####> ~
~ <phone|+## ## #### ####> <card|################> ~
~ <card|################> <phone|+1 (###) ###-####>, ~
~ <card|################> <ip|1##.##.##.##> ~
~ ~ ~ ~ ~ ~ ~ ~
^ ~ ~, ~ ~ ~. ^ ~
in ####, ~ ~ #### ~
####-##-## ##:##:## ~ ~
on ##/##/#### ~ ~ ~
##.##.#### ~ ~
~ ####-##-##T##:##:##Z ~
~ ## ~ ~ ### ~
price $#,###.## ~
€ ###.### ~
~ ##.## % ~ ~
version #.#.# ~
v##.#.## ~ ~
release #.##.#-rc#
order ######## ~
order no. ###-####### ~
invoice #####-##
~ a#b##c###d##e#f ~
~ ########e##a####cee##dd# ~ ~
key f##b#d#c##f####a#d#b###ff
id ########-####-####-####-############
ISBN 978-#-##-######-#
isbn 978#########
~ ##########e-## ~
sum ###,###,### ~
### ### ### ~
table # ## ### #### #####
# # # # # # # # # # # #
pages ###-### ~
chapter # ~, p. ##
~ ####-#### ~ ~
zip ##### ~
#####-#### ~ ~
ssn ###-##-#### ~
##:## ~ ##:## ~
~@~ ~ ~
@~ ~ ~ ~
@~## ~
~ ~ at ~ ~ the ~
dot ~ ~ ~
~ dot ~ at ~ ~
(at) ~ ~
~ at ## ~ ~
#.# dot #.#
lat ##.##### lon -##.#####
x = #.##e-##, y = ###
[##] ~ ~ ####; ##: ###-###.
https://~.com/~/####/##/~
~.##.~ ~ #.~
#### x #### px
+## % ~
+#.## ~
(####) ~ ~
serial ####-####-##
~ ### | ### | ### | ### ~
####################### ~
~ ##.###.#.##### ~
section #.#.#.#.# ~
~###@ ~ ~
###-#### ~
"""

FILLED = 8  # ways in which a row is filled in
_MARK = re.compile(r"<(\w+)\|([^>]*)>")
_PARTS = "an de che lo ver ti ung re mon sa qui ent ó é ß ü ing th er ou".split()


def _fill(row: str, draw: random.Random) -> str:
    def word() -> str:
        return "".join(draw.choice(_PARTS) for _ in range(draw.randint(1, 4)))

    named = [str(draw.randint(0, 9)) if c == "#" else word() if c == "~" else word().capitalize() if c == "^" else c for c in row]
    return "".join(named)


def examples(rows: str = ROWS, filled: int = FILLED) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, spans) of all rows; a span is (kind, start, end) in code points."""
    draw = random.Random(13)
    out = []
    for row in filter(None, rows.split("\n")):
        for _ in range(filled):
            text, spans, at = "", [], 0
            full = _fill(row, draw)
            for mark in _MARK.finditer(full):
                text += full[at : mark.start()]
                spans.append((mark[1], len(text), len(text) + len(mark[2])))
                text, at = text + mark[2], mark.end()
            out.append((text + full[at:], spans))
    return out
