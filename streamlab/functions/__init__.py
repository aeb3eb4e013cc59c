from streamlab.functions import geo, rides, text
from streamlab.functions.sql import register_functions

__all__ = ["geo", "register_functions", "rides", "text"]
