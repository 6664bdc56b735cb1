"""The registered queries: name -> (Spark query, equivalent SQL or None)."""

from statloom.catalogue import association, models, preparation, publishing, regression

ALL = {**association.QUERIES, **regression.QUERIES, **preparation.QUERIES, **models.QUERIES, **publishing.QUERIES}
