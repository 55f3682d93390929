"""Keys that the novelty scan must find, whatever their alphabet, length and place."""

import random
import string

import pytest

from replylens.llm import secret_scan

ALPHABETS = {
    "base64": string.ascii_letters + string.digits + "+/",
    "base32": string.ascii_uppercase + "234567",
    "hex": "0123456789ABCDEF",
}
KEY, OTHER = "Zk3vQ9xT7bLm2RwY8pNc4HsJ6dFg1Aue", "pL0wXe5RtB8nQz2VjK7yMs4HcGd9Fa3U"


def novel(text):
    return [text[start:end] for start, _, end in secret_scan.SecretScanner().novel(text, text.lower(), [])]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_random_keys_of_any_length(alphabet):
    rng = random.Random(alphabet)
    for n in (16, 24, 32, 33, 64, 65, 128, 256, 512, 1200, 3200, 4096, 4097, 8192):
        for _ in range(10):
            key = "".join(rng.choices(ALPHABETS[alphabet], k=n))
            assert novel(f'def run():\n    private_key = "{key}"\n    return private_key\n') == [key], n


def test_ordinary_strings_of_any_length():
    for name in ("default_configuration_parameter_name", "getAuthenticationProviderRegistry", "a" * 5000, "request_session_" * 300):
        assert novel(f"def run():\n    private_key = {name}\n    return 1\n") == []


def test_every_string_in_context_is_measured():
    assert novel(f'credentials_for_production = "{KEY}"') == [KEY]
    assert novel(f"private_key_for_service_account={KEY}\n") == [KEY]
    assert novel(f"session keys: {KEY}, {OTHER}") == [KEY, OTHER]
    assert novel("session keys:\n" + f"  - {KEY}\n  - {OTHER}\n") == [KEY, OTHER]
    assert novel(f'private_key = load_default_configuration(environment, "database", "{KEY}")') == [KEY]
    assert novel(f"Authorization: {'realm, ' * 30}{KEY}\n") == [KEY]
    assert novel(f"webhook-{KEY}") == [f"-{KEY}"]


@pytest.mark.parametrize("before", ["X-Api-Key: ", "the password for the database is ", "passwd for root ", "token of the day ", "apikey, "])
def test_words_of_the_fixed_forms_are_sensitive(before):
    assert novel(before + KEY) == [KEY]


def test_context_ends():
    assert novel(f"private notes and {'word ' * 30}{KEY}") == []
    assert novel(f"private notes: a\nnext line\n{'word ' * 30}{KEY}") == []
