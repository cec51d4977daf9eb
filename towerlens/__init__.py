"""towerlens: a Spark-native medallion pipeline for subscriber, usage-event and
site analytics (bronze audit -> silver cleaning -> gold marts -> business
queries), written as DataFrame -> DataFrame operators."""

__version__ = "0.1.0"
