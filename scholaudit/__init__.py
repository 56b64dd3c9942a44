"""Open-science audit engine on PySpark.

From a table of scholarly works, open-access locations and each institution's
own lists, the package builds three tables: trial identifiers per publication
(``alltrials``), registered trials linked to publications (``trials``) and
publications with open-science labels (``pubs``).
"""
