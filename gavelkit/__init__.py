"""Market analytics for priced items on PySpark."""

from gavelkit.session import get_session
from gavelkit.params import Params

__all__ = ["Params", "get_session"]
