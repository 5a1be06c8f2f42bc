"""Run the ridership and price pipeline; see tapflow/plans/job.py for the arguments."""

from pyspark.sql import SparkSession

from tapflow.plans.job import main

if __name__ == "__main__":
    session = SparkSession.builder.appName("tapflow").getOrCreate()
    for path in main(session):
        print(path)
    session.stop()
