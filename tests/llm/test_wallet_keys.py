"""Extended private keys: the published test vector is found, a broken one is not."""

from skyledger.llm import secrets

# Fixed value: the master key of test vector 1 of BIP 32.
KEY = "xprv9s21ZrQH143K3QTDL4LXw2F7HEK3wJUD2nW2nRk4stbPy6cq3jPPqjiChkVvvNKmPGJxWUtg6LnF5kejMRNNU3TGtRBeJgk33yuGBxrMPHi"


def found(text):
    return [(secrets.KINDS[k].name, text[a:b]) for a, k, b in secrets.spans(text)]


def test_a_key_with_its_checksum():
    assert found(f"İ wallet {KEY}, kept") == [("wallet", KEY)]


def test_broken_keys():
    assert found(KEY[:-1] + "j") == [] and found(KEY[:-1]) == [] and found(KEY + "1") == []
    assert found(KEY.replace("9s21", "9s22")) == []
