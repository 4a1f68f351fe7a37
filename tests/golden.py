"""Hand-written dump articles, one per rule."""

from dumpscope.constants import END_MARKER as END
from dumpscope.constants import TITLE_MARKER as TITLE

DUMP = f"""a preamble line
{TITLE} A%2CB
Plain start of [[alpha|Alpha]] and [[beta#part]].
==History==
'''Bold''' not prose
===Early years===
More text {{{{cite|x}}}} here, can't stop!
{END}
junk between [[lost]]
{TITLE} Wikipedia:Help
[[inside]] a page of a namespace
{END}
{TITLE} Caf%C3%A9
{END}
{TITLE} 2001:_X
colon title
{END}
{TITLE} Twice
first
{END}
{TITLE} Twice
second
{TITLE} Inner
still the second
{END}
{TITLE} Redirected
#REDIRECT [[Twice]]
{END}
{TITLE} Cyclist
Naïve text about a unicycle.\r
Second line\r
{END}
{TITLE} Truncated
this article has no end"""
