"""ledgerline: a retail sales pipeline on Spark.

raw POS lines -> validated staging -> star schema -> marts, store-day
features and an isolation-forest watch-list, all as DataFrame jobs.  See
``ledgerline.plans.jobs`` for the job chain and ``ledgerline.plans.catalog``
for the registered queries.
"""

__version__ = "0.1.0"
