"""Row makers shared by the tests of the training-data operators."""

#: Extra columns whose names the operators use themselves.
EXTRA = ("score", "lang_pred", "fingerprint", "component_id", "n_lines", "n_removed", "at", "th", "name", "bin_id", "shard", "fp", "key")


def words(r, n, alphabet="abcdefgh"):
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 6))) for _ in range(n))
