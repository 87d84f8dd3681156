"""Labelled findings: secrets and what looks like them, in the contexts in which they stand.

Nobody publishes real secrets with labels, so these are made from rules: each
kind says how its value is formed and what stands around it, and whether it is
a secret follows from the kind, not from the value's looks.  Hard negatives share
their values' form with secrets: a commit hash has the form of a hex token, a
build id that of a key.
"""

from __future__ import annotations

import base64
import random
import string
import zlib
from dataclasses import dataclass

WORDS = (
    "password secret token user admin login value config server client data name file path build release version commit update change "
    "number order account master system example sample default change your here insert enter test dummy none null true false public "
    "static final return string object class index table query result message header content image script style button container "
    "welcome hello world monday summer winter dragon monkey shadow sunshine football letme princess"
).split()
_HEX, _ALNUM = "0123456789abcdef", string.ascii_letters + string.digits
_KEYS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "auth", "client_secret", "DB_PASSWORD", "SECRET_KEY", "TOKEN", "private_key")
_SIGNS = ("=", " = ", ": ", ":", "=\"", " = \"", ": \"", "='", " => '")
_PATHS = ("", "", "src/config.py", "deploy/prod.env", "app/settings.yml", "web", "mail", "forum/post")
_PROSE = ("we saw", "it was", "please see", "then the", "and after that", "on monday the", "as noted in", "call me at")


def _chars(r: random.Random, alphabet: str, n: int) -> str:
    return "".join(r.choice(alphabet) for _ in range(n))


def _mixed(r: random.Random, n: int) -> str:
    """Letters and digits with at least one of each."""
    own = list(_chars(r, _ALNUM, n - 2) + r.choice(string.digits) + r.choice(string.ascii_letters))
    r.shuffle(own)
    return "".join(own)


def _uuid(r: random.Random) -> str:
    h = _chars(r, _HEX, 32)
    return "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:]))


def _base64(r: random.Random, n: int) -> str:
    return base64.b64encode(r.randbytes(n)).decode()


def _assigned(r: random.Random, keys=_KEYS) -> str:
    return r.choice(keys) + r.choice(_SIGNS)


def _said(r: random.Random, *words: str) -> str:
    return f"{r.choice(_PROSE)} {r.choice(words)} "


def _case(r: random.Random, text: str) -> str:
    return r.choice((text, text, text.upper()))


#: kind -> (label, rule giving value, what stands before it).  Nothing here is a real secret.
KINDS = {
    "cloud key": (1, lambda r: ("AKIA" + _chars(r, string.ascii_uppercase + string.digits, 16), r.choice((_assigned(r), _said(r, "key", "id is"), "")))),
    "hex token": (1, lambda r: (_case(r, _chars(r, _HEX, r.choice((16, 18, 20, 32, 40, 64)))), _assigned(r))),
    "random token": (1, lambda r: (_mixed(r, r.choice((16, 20, 24, 32, 40))), _assigned(r))),
    "base64 key": (1, lambda r: (_base64(r, r.choice((15, 18, 24, 30))), _assigned(r))),
    "web token": (1, lambda r: (f"eyJ{_mixed(r, 20)}.eyJ{_mixed(r, 30)}.{_mixed(r, 32)}", r.choice((_assigned(r), _said(r, "bearer", "use"))))),
    "password": (1, lambda r: (_chars(r, _ALNUM, 2) + r.choice(string.digits) + r.choice("!@#$%^*?.-") + _mixed(r, r.randint(4, 8)), _assigned(r))),
    "short password": (1, lambda r: (_chars(r, "bcdfghjklmnpqrstvwxz", r.randint(6, 9)) + r.choice(("", _chars(r, string.digits, 3))), _assigned(r))),
    "url password": (1, lambda r: (_chars(r, "bcdfghjkmnpqrstvwxz", 2) + r.choice(string.digits) + r.choice("!#$-.") + _mixed(r, 6), r.choice(("postgres", "https", "amqp")) + "://app:")),
    "passphrase": (1, lambda r: (" ".join(_chars(r, "bcdfghjklmnpqrstvwxz0123456789", r.randint(2, 5)) for _ in range(4)), r.choice(_KEYS + ("passphrase",)) + r.choice((" = \"", ": '", " => '", "=\"")))),
    "plain password": (1, lambda r: (r.choice(WORDS[-10:]) + _chars(r, string.digits, r.randint(2, 4)), _assigned(r, ("password", "passwd", "pwd", "DB_PASSWORD")))),
    "commit hash": (0, lambda r: (_chars(r, _HEX, r.choice((12, 40))), r.choice((_said(r, "commit", "revision", "sha"), "commit ", "git checkout ", "merged as ", "tree/")))),
    "checksum": (0, lambda r: (_case(r, _chars(r, _HEX, r.choice((32, 40, 64)))), r.choice(("md5: ", "sha256:", "checksum = ", "sha1=", "digest: ", "etag: \"", "hash: ")))),
    "uuid": (0, lambda r: (_uuid(r), r.choice((_said(r, "id", "device", "request"), "id=", "uuid: ", "guid = \"", "request_id: ", "")))),
    "build id": (0, lambda r: (f"{r.choice(('build', 'release', 'rc', 'job', 'image'))}-{_mixed(r, r.randint(10, 16))}", r.choice((_said(r, "build", "image"), "build: ", "version=", "tag: ")))),
    "image data": (0, lambda r: (_base64(r, r.choice((30, 60, 120))), r.choice(("data:image/png;base64,", "src=\"data:image/gif;base64,", "url(data:image/svg;base64,")))),
    "number": (0, lambda r: (_chars(r, string.digits, r.randint(12, 18)), r.choice((_said(r, "number", "order", "card"), "", "phone: ", "id=", "isbn ", "key: ", "token: ")))),
    "number after a word": (0, lambda r: (_chars(r, string.digits, r.choice((12, 14, 16))), f"{_chars(r, string.ascii_lowercase, 4)} {_chars(r, string.ascii_lowercase, 6)} ")),
    "identifier": (0, lambda r: ("_".join(r.sample(WORDS, 2)) + str(r.randint(1, 99)), r.choice((_said(r, "class", "table"), "class=\"", "id=\"", "name=")))),
    "path": (0, lambda r: ("/".join(r.sample(WORDS, 3)) + f"/v{r.randint(1, 9)}/{r.randint(100, 999)}", r.choice(("path=", "href=\"", "src=\"", "file: ", _said(r, "file"))))),
    "placeholder": (0, lambda r: (r.choice(("your_{}_here", "<{}>", "{}_goes_here", "change{}", "insert-{}-here", "xxxx{}xxxx", "example{}")).format(r.choice(WORDS)), _assigned(r))),
    "reference": (0, lambda r: (r.choice(("${{{}}}", "$({})", "os.getenv({})", "config.{}", "get_{}()", "process.env.{}", "{{{{ {} }}}}")).format(r.choice(WORDS)), _assigned(r))),
    "word": (0, lambda r: (r.choice(WORDS), _assigned(r))),
    "short word": (0, lambda r: (r.choice(("the", "a", "an", "is", "it", "for", "not", "and", "you", "in", "of", "to", "if", "no", "yes", "on", "off", "we", "any", "all", "was", "has", "see")), _assigned(r))),
    "sentence": (0, lambda r: (" ".join(r.sample(WORDS, r.randint(3, 6))), r.choice(_KEYS) + r.choice((" = \"", ": '", "=\"")))),
    "sample": (0, lambda r: (_mixed(r, 20), r.choice(("example ", "sample ", "# test ")) + _assigned(r))),
}
PER_KIND = 150


@dataclass(frozen=True)
class Finding:
    candidate: str
    before: str
    after: str
    path: str
    label: int
    kind: str


def findings(per_kind: int = PER_KIND, seed: int = 3) -> list[Finding]:
    """``per_kind`` findings of each kind."""
    r = random.Random(seed)
    out = []
    for kind, (label, rule) in KINDS.items():
        for _ in range(per_kind):
            value, before = rule(r)
            closing = before[-1:] if before[-1:] in "'\"" else ""
            after = closing + r.choice(("", "\n", " ", ";", " and then", ", "))
            lead = r.choice(("", "", " ".join(_chars(r, string.ascii_lowercase, r.randint(2, 8)) for _ in range(3)) + " "))
            after = "@db.host/x" if kind == "url password" else after
            out.append(Finding(value, (lead + before)[-40:], after, r.choice(_PATHS), label, kind))
    return out


def held_out(finding: Finding) -> bool:
    """Whether a finding is kept from training, by a hash of its value."""
    return zlib.crc32(finding.candidate.encode()) % 3 == 1
