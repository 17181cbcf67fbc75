"""A relational analytics engine on Spark DataFrames.

``connect`` gives a connection (SQL text, readers, registered objects, functions), whose queries
are lazy relations; ``expressions`` composes columns; ``functions`` has the DataFrame functions.
"""

from .expressions import (
    CaseExpression, CoalesceOperator, ColumnExpression, ConstantExpression, DefaultExpression, Expression, FunctionExpression, LambdaExpression, SQLExpression, StarExpression,
)
from .relation import Relation
from .session import Connection, connect, default_connection, relation

__all__ = [
    "CaseExpression", "CoalesceOperator", "ColumnExpression", "Connection", "ConstantExpression", "DefaultExpression", "Expression", "FunctionExpression", "LambdaExpression",
    "Relation", "SQLExpression", "StarExpression", "connect", "default_connection", "relation",
]
