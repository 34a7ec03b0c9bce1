"""Account-churn analytics written as Spark DataFrame transformations."""
