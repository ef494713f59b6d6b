"""The one exception class for failed preconditions."""


class RegistryError(ValueError):
    """A required column, value or input is missing or invalid."""


def require_columns(columns, required, what="input"):
    """Raise unless every required name is among ``columns`` (exact names)."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise RegistryError(
            f"{what}: missing required column(s) {', '.join(missing)}; found {', '.join(columns)}"
        )
