"""cotejo: keep registry tables in step with their source data, and audit the result.

Every public function takes and returns DataFrames; nothing here collects data to the driver.
"""

from cotejo.errors import RegistryError
from cotejo.session import build_session

__all__ = ["RegistryError", "build_session"]
