"""Session settings: checkpoint folder and shuffle sizing come from the job configuration."""

from viaduct.session import PIPELINE_CONF, checkpoint_dir, scratch_path


def test_checkpoint_folder_is_the_sessions(spark):
    folder = checkpoint_dir(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert folder.rstrip("/").split(":")[-1].startswith(configured.rstrip("/").split(":")[-1])
    assert scratch_path(spark, "t").startswith(folder.rstrip("/") + "/tables/t-")
    assert scratch_path(spark, "t") != scratch_path(spark, "t")


def test_pipeline_settings_applied(spark):
    for key, value in PIPELINE_CONF.items():
        assert spark.conf.get(key) == value
    assert spark.conf.get("spark.ui.enabled") == "false"
