from paceline.functions import cleaning, names  # noqa: F401
from paceline.functions.names import normalise_columns, snake_name  # noqa: F401
