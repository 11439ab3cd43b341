"""Note analytics and readmission prediction as PySpark DataFrame jobs."""
