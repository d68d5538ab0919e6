"""Labelled findings to train the secret filter on: made by a rule, so that no real secret is kept anywhere.

Each finding is (value, before, after, path, label): a candidate, the text around it, the path it was found in, and
whether it is a secret. Positives are random keys and passwords assigned or named as such; negatives are what looks like
them: digests, commits, identifiers, paths, versions, placeholders, numbers, addresses and encoded data.
"""

from __future__ import annotations

import random

_HEX = "0123456789abcdef"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_MIXED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_LETTERS = _MIXED[:52]
_PLAIN = ("the results were stored", "see the list of", "in this part we", "and then it was", "of which the", "du texte et de la", "und dann wird das", "en la parte de", "they went to", "as seen in")
_PATHS = ("src/app/config.py", "deploy/prod.env", "notes.txt", "", "", "", "lib/client.js", "main.tf")
_TEST_PATHS = ("tests/fixtures/data.json", "docs/example.md", "examples/sample.py", "test/keys.txt")


def labelled_findings(n: int = 2400, seed: int = 11) -> list[dict]:
    """``n`` findings of long runs, and as many of short or punctuated assigned values, half of them secrets; the same for the same seed."""
    rng = random.Random(seed)
    text = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    names = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "auth_token", "client_secret", "private_key", "credential", "pwd", "passwort", "kennwort", "geheim", "mot_de_passe", "contrasena", "clave_secreta")
    assign = (' = "', '="', "=", ": ", ' = ', "='", '": "')

    def positive() -> dict:
        kind = rng.randrange(7)
        value = (
            text(_LETTERS, rng.choice((20, 24, 32, 40))) if kind == 6
            else text(_HEX, rng.choice((18, 20, 24, 32, 40, 48, 64))) if kind < 2
            else "AKIA" + text(_UPPER, 16) if kind == 2
            else rng.choice(("ghp_", "sk-", "glpat-", "npm_", "xoxb-")) + text(_MIXED, rng.choice((24, 36, 40))) if kind == 3
            else text(_MIXED, rng.choice((20, 24, 32, 40)))
        )
        named = kind not in (2, 3) or rng.random() < 0.4
        before = f"{rng.choice(_PLAIN)} {rng.choice(names)}{rng.choice(assign)}" if named else rng.choice(_PLAIN) + " "
        return {"value": value, "before": before, "after": rng.choice(('"', "'", " ", "", '"\n', " " + rng.choice(_PLAIN))), "path": rng.choice(_PATHS), "label": 1.0}

    def negative() -> dict:
        kind = rng.randrange(13)
        before, after, path = rng.choice(_PLAIN) + " ", " " + rng.choice(_PLAIN), rng.choice(_PATHS)
        word = lambda k=None: "".join(rng.choice(("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve", "sch", "ung", "tion", "ment", "eur", "que")) for _ in range(k or rng.randrange(1, 5)))
        if kind == 0:
            value, before = text(_HEX, 40), before + rng.choice(("commit ", "rev ", "sha1 ", "sha: ", "checkout "))
        elif kind == 1:
            value, before = text(_HEX, rng.choice((32, 64))), before + rng.choice(("md5 ", "sha256: ", "checksum=", "digest ", "etag: ", "hash "))
        elif kind == 2:
            value = "-".join(text(_HEX, k) for k in (8, 4, 4, 4, 12))
            before += rng.choice(("id ", "uuid=", "request_id: ", "session id ", ""))
        elif kind == 3:
            value = "/".join(rng.choice(("usr", "lib", "python3", "src", "data", "model", "v2", "image01", "home", "file7", "test", "part2")) for _ in range(rng.randrange(4, 7)))
        elif kind == 9:  # long words, alone and in their sentence
            value = word(rng.randrange(8, 14))
            value = rng.choice((value, value.title(), value.upper()))
        elif kind == 10:  # words held together
            value = rng.choice("-_/").join(word() for _ in range(rng.randrange(4, 8)))
            before, after = rng.choice((before, "", "https://", "see ", "(")), rng.choice((after, ".", ")", " "))
        elif kind == 11:  # names in code
            value = "".join(word().title() for _ in range(rng.randrange(4, 7)))
            before, after = rng.choice((before, "class ", "import ", "new ")), rng.choice((after, "(", "."))
        elif kind == 12:  # rules and fillers
            value = rng.choice("-_=/+x") * rng.randrange(16, 60)
            before, after = rng.choice(("", "\n", before)), rng.choice(("", "\n", after))
        elif kind == 4:
            value = rng.choice(("your_api_key_here1", "example_token_12345", "password_example_1", "test-secret-value-01", "my-sample-key-00001", "changeme_password_1", "insert_token_here_1", "dummy_secret_00000"))
            before = f"{before}{rng.choice(names)}{rng.choice(assign)}"
        elif kind == 5:
            value = text("0123456789", rng.choice((16, 18, 19, 20, 24)))
            before += rng.choice(("order ", "number ", "account ", "phone ", "isbn ", "at "))
        elif kind == 6:
            value = f"{rng.choice(('release', 'package', 'version', 'module', 'build', 'project'))}-{rng.choice(('client', 'server', 'common', 'core', 'linux', 'data'))}-{rng.randrange(10)}-{rng.randrange(100)}-{rng.randrange(10)}"
        elif kind == 7:
            value, before, path = text(_MIXED, rng.choice((20, 32))), f"{before}{rng.choice(names)}{rng.choice(assign)}", rng.choice(_TEST_PATHS)
            before = rng.choice(("example ", "sample ", "dummy ", "fake ")) + before
        else:
            value = "".join(rng.choice(("data", "user", "name", "table", "index", "file", "image", "group", "value", "count")).title() for _ in range(rng.randrange(3, 6))) + str(rng.randrange(1, 99))
        return {"value": value, "before": before, "after": after, "path": path, "label": 0.0}

    lower, signs = _MIXED[26:52], ".!@#$%&*?+-_"
    stems = ("copper", "dragon", "Summer", "Winter", "hunter", "monkey", "P4ss", "Qwerty", "letmein", "Sunshine", "correct", "battery", "staple", "shadow", "Falcon", "river", "Zebra")

    def assigned_positive() -> dict:
        kind = rng.randrange(7)
        value = (
            text(_MIXED, rng.randrange(8, 16)) if kind == 0
            else text(_MIXED + signs, rng.randrange(8, 25)) if kind == 1
            else rng.choice(stems) + rng.choice(signs) + text("0123456789", rng.randrange(1, 4)) + rng.choice(("", "-", "!", "&")) + rng.choice(stems) if kind == 2
            else rng.choice(stems) + text("0123456789", rng.randrange(1, 5)) + rng.choice(("", "!", "#", "$")) if kind == 3
            else text("0123456789", rng.randrange(4, 13)) if kind == 4
            else text(_MIXED[:52], rng.randrange(8, 30)) if kind == 5
            else text(lower, rng.randrange(8, 16))
        )
        quoted = kind == 6 or rng.random() < 0.6
        name = rng.choice(names) + rng.choice(("", "", "", "_1", "_prod", "_of_app_01", "_number_2", "_hash", "_for_db"))
        before = f"{rng.choice(_PLAIN)} {name}{rng.choice((' = ', '=', ': ', ':', '": '))}" + ('"' if quoted else "")
        return {"value": value, "before": before, "after": '"' + rng.choice(("", ",", " ", "\n")) if quoted else rng.choice(("", "\n", " ", ",", ";", " " + rng.choice(_PLAIN))), "path": rng.choice(_PATHS), "label": 1.0}

    def assigned_negative() -> dict:
        kind = rng.randrange(7)
        name, quoted, path = rng.choice(names), rng.random() < 0.4, rng.choice(_PATHS)
        after = rng.choice(("", "\n", " ", ")", ","))
        if kind == 0:
            value = rng.choice(("getpass(", "get_token(", "os.environ[", "os.getenv(", "self.password", "config.token", "settings.SECRET", "process.env.TOKEN", "request.args[", "${PASSWORD", "$TOKEN", "$(cat", "{{password", "%PASSWORD%", "user.password", "env.API_KEY", "load_key(path", "args.secret", "params.token"))
            quoted = False
        elif kind == 1:
            value = rng.choice(("true", "false", "null", "None", "string", "str", "bool", "required", "optional", "Basic", "Bearer", "hidden", "password", "undefined", "bytes", "oauth2", "****", "********", "xxxxxxxx", "......"))
        elif kind == 2:
            value, quoted = rng.choice(("nothing", "they", "this", "there", "people", "every", "never", "always", "have", "when", "what", "work", "hard", "patience", "listen", "simple", "keep", "Never", "Start", "under-stated", text(lower, rng.randrange(4, 11)))), False
            after = rng.choice((" ", ", ")) + rng.choice(_PLAIN)
        elif kind == 3:
            value = rng.choice(("changeme", "your_token", "your-key", "example", "dummy123", "test", "placeholder", "insert_here", "sample_key", "fake-token", "example1!", "your.password"))
        elif kind == 4:
            name = rng.choice(("author", "authors", "authenticated", "max_tokens", "tokens", "token_count", "token_type", "auth_url", "secret_name", "password_length", "key_id", "token_limit", "pwd_path", "auth_type", "password_file", "token_expiry", "secret_id"))
            value = rng.choice((text("0123456789", rng.randrange(4, 8)), rng.choice(stems), text(lower, rng.randrange(4, 11)), "/run/" + text(lower, 6) + "/" + text(lower, 5), text(_MIXED, rng.randrange(6, 14))))
        elif kind == 5:
            value, path = rng.choice((text(_MIXED, rng.randrange(8, 15)), rng.choice(stems) + text("0123456789", 2))), rng.choice(_TEST_PATHS)
            name = rng.choice(("example ", "sample ", "dummy ", "fake ")) + name
        else:
            value = rng.choice(("http://", "https://", "//")) + text(lower, rng.randrange(4, 9)) + rng.choice((".com/login", ".org", ".example/token"))
        before = f"{rng.choice(_PLAIN)} {name}{rng.choice((' = ', '=', ': ', '": '))}" + ('"' if quoted else "")
        return {"value": value, "before": before, "after": '"' if quoted else after, "path": path, "label": 0.0}

    rows = [positive() if i % 2 else negative() for i in range(n)]
    return rows + [assigned_positive() if i % 2 else assigned_negative() for i in range(n)]
